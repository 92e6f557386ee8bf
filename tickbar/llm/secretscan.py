"""Secrets in texts, by assignments.

Every operator that assigns (`=`, `:`, `:=`, `=>`, `+=`) is lexed into a target name and an expression:
the syntax of programs (quoted, triple-quoted and template strings, concatenation, typed
declarations, subscripts, keyword arguments, defaults of environment look-ups), of settings (ini,
env, properties, YAML, JSON, command-line options, name/value pairs, XML elements) and the user
part of URLs.  Literals keep their places; constants are propagated: an expression that names an assigned
constant carries its literals on, in any order of the lines and through chains.  A literal is scored by the most sensitive
target that it reaches, and by how random it looks; placeholders and sentences score low.

Base rules (assign, access, hex) are patterns that hold whatever the lexer finds; their spans stay, and the
lexer adds `literal` (the target of the literal itself is sensitive) and `flow` (a target that it flows to is).
A literal inside an `assign` span is that span's own value and isn't reported again.

Defined results: a null text has no findings, like an empty one; offsets count code points; texts are
read whole, in time that grows with their length; equal rows get equal findings.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, lean, slices, without

# The base rules, and the order of the kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a maximal run of 18 or more
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LENGTH = 12
KINDS = ("assign", "access", "hex", "literal", "flow")

# How sensitive a name is, by its words, and what takes it back.
WORDS = {"password": 1.0, "passwd": 1.0, "passwort": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 0.9, "pass": 0.8,
         "secret": 1.0, "secrets": 0.9, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "cred": 0.7,
         "authorization": 0.8, "bearer": 0.8, "auth": 0.6, "signature": 0.6, "salt": 0.6, "webhook": 0.6, "dsn": 0.5}
PAIRS = {("api", "key"): 1.0, ("access", "key"): 1.0, ("private", "key"): 1.0, ("secret", "key"): 1.0, ("signing", "key"): 0.9,
         ("encryption", "key"): 0.9, ("master", "key"): 0.9, ("account", "key"): 0.9, ("auth", "key"): 0.9,
         ("client", "secret"): 1.0, ("connection", "string"): 0.7}
HARMLESS = {"name", "id", "url", "uri", "path", "file", "dir", "length", "len", "size", "count", "type", "field", "label",
            "hint", "prompt", "public", "expiry", "expires", "ttl", "policy", "regex", "format", "placeholder", "title", "column"}
THRESHOLD = 0.5

_OPERATOR = re.compile(r"=>|:=|\+=|[=:]")
_WORDS_OF = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_IDENT = re.compile(r"[A-Za-z_$][\w$]*(?:(?:\.|->|::)[A-Za-z_$][\w$]*)*")
_OPEN = re.compile(r"(?P<prefix>[A-Za-z]{0,2})\\?(?P<quote>\"\"\"|'''|[\"'`])")
_BARE = re.compile(r"[^\s\"'`,;<>(){}\[\]&|\\=]+(?:={1,2}(?=[\s\"'`,;<>(){}\[\]&|\\]|$))?")
_GAP = re.compile(r"[^\S\n]*")
_JOINT = re.compile(r"\s*(?:\+|\.\.?|\|\||&)\s*(?=[A-Za-z_$\"'`])|[^\S\n]+(?=[\"'])")
_SLOT = re.compile(r"\$?\{\s*([A-Za-z_$][\w$.]*)\s*\}|\$([A-Za-z_]\w*)")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.:-]*)>([^<>\s][^<>\n]*)</\1>")
_OPTION = re.compile(r"(?<!\S)--([A-Za-z][\w-]*)[^\S\n]+([^\s\"'-][^\s\"']*)")
_LOGIN = re.compile(r"://[^\s/:@\"']+:([^\s/@\"']+)@")
_SCHEME = re.compile(r"(?:Bearer|Basic|Digest)[^\S\n]+(?=\S)", re.I)
_PLACEHOLDER = re.compile(r"(?:change.?me|example|sample|dummy|placeholder|your|todo|none|null|nil|undefined|true|false|test|"
                          r"redacted|masked|insert|replace)", re.I)
_TYPES = {"string", "str", "char", "text", "varchar", "auto", "var", "let", "const", "object", "bytes", "any"}
_LOOKUP = re.compile(r"(?:^|[.>:_])(?:get|getenv|env|environ|getproperty|get_or_default|getordefault|setdefault)$", re.I)


def sensitivity(name: str) -> float:
    """0 to 1: how likely the target `name` holds a secret, by its words."""
    words = [w.lower() for w in _WORDS_OF.findall(name)]
    score = max((WORDS.get(w, 0.0) for w in words), default=0.0)
    score = max([score, *(PAIRS.get(p, 0.0) for p in zip(words, words[1:], strict=False))])
    return 0.3 * score if words and words[-1] in HARMLESS else score


def randomness(value: str) -> float:
    """0 to 1: how much a literal looks like a secret's value."""
    n = len(value)
    if n < 6 or len(set(value)) < 4 or _PLACEHOLDER.match(value) or value[0] in "<%{" or value.startswith("${"):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = (bool(re.search("[a-z]", value)) + bool(re.search("[A-Z]", value)) + bool(re.search(r"\d", value))
               + bool(re.search(r"[^\w\s]", value)))
    score = min(1.0, entropy / 3.5) * min(1.0, (n + 4) / 12) * min(1.0, 0.55 + 0.15 * classes)
    return score * (0.4 if re.search(r"\s", value) else 1.0) * (0.6 if value.isalpha() and value.islower() else 1.0)


class Part(NamedTuple):
    """A part of an expression: a literal (no name), a constant (no place), or a bare word, which may be either."""

    start: int
    end: int
    name: str | None = None


class Lexer:
    """The pairs of a target and its expression's parts, of one text."""

    def __init__(self, text: str):
        self.text = text
        self.pairs: list[tuple[str, list[Part]]] = []
        self._read()

    def _read(self) -> None:
        text, named, inside = self.text, None, 0
        for found in _OPERATOR.finditer(text):
            at, end = found.span()
            if (at < inside and found[0] == ":") or text[end:end + 1] in ("=", ":") or text.startswith("//", end) \
                    or text[max(at - 1, 0):at] in ("=", "!", "<", ">", ":"):
                continue
            name = self._target(at)
            if not name:
                continue
            parts, stop = self._expression(end, found[0] == ":")
            if not parts:
                continue
            if len(parts) == 1 and parts[0].name is None:
                inside = stop if text[stop - 1:stop] not in ("'", '"', "`") else 0  # colons of a bare word belong to it
            if found[0] == "+=":
                parts.append(Part(-1, -1, name))
            last = _last(name).lower()
            if last == "value" and named:  # `name: X` and `value: literal` side by side
                name = named
            named = text[parts[0].start:parts[0].end] if last in ("name", "key") and len(parts) == 1 else None
            self.pairs.append((name, parts))
        if "</" in text:
            self.pairs += [(m[1], [Part(*m.span(2))]) for m in _ELEMENT.finditer(text)]
        if "--" in text:
            self.pairs += [(m[1], [Part(*m.span(2))]) for m in _OPTION.finditer(text)]
        if "://" in text:
            self.pairs += [("password", [Part(*m.span(1))]) for m in _LOGIN.finditer(text)]

    def _back(self, at: int, chars: str) -> int:
        text = self.text
        while at > 0 and text[at - 1] in chars:
            at -= 1
        return at

    def _word(self, end: int) -> tuple[int, str]:
        """The identifier (dots and dashes included) that ends at `end`."""
        text, at = self.text, end
        while at > 0 and (text[at - 1].isalnum() or text[at - 1] in "_$.->" and not (text[at - 1] == ">" and text[at - 2:at - 1] != "-")):
            at -= 1
        return at, text[at:end].strip(".->")

    def _target(self, at: int) -> str:
        """The name that an operator at `at` assigns to."""
        text = self.text
        end = self._back(at, " \t")
        if text[end - 2:end] == "[]":
            end = self._back(end - 2, " \t")
        if text[end - 1:end] == "]":
            end = self._back(end - 1, " \t")
        if text[end - 1:end] in ('"', "'", "`") and end:  # a quoted key
            quote, close = text[end - 1], end - 1
            while close > 0 and text[close - 1] == "\\":
                close -= 1
            start = close
            while start > 0 and text[start - 1] != quote and text[start - 1] not in "\n=,;{}":
                start -= 1
            return text[start:close].strip("\\ ") if start and text[start - 1] == quote else ""
        start, name = self._word(end)
        if not name:
            return ""
        before = self._back(start, " \t*")
        if text[before - 1:before] == ":" and before and text[before - 2:before - 1] != ":" and text[at] != ":":  # name: type = value
            typed = self._word(self._back(before - 1, " \t"))[1]
            return typed or name
        if name.lower() in _TYPES and before < start:  # name type = value
            return self._word(before)[1] or name
        return name

    def _expression(self, at: int, config: bool) -> tuple[list[Part], int]:
        """The parts of the expression that starts at `at`, and its end."""
        text, parts = self.text, []
        at = _GAP.match(text, at).end()
        if config and text[at:at + 1] == "\n":
            return [], at
        while True:
            if opened := _OPEN.match(text, at):
                end = self._string(opened, parts)
                if end < 0:
                    break
                at = end
            elif (ident := _IDENT.match(text, at)) and text[ident.end():ident.end() + 1] == "(":
                # the default of a look-up; of any other call, its first argument
                at = (self._default if _LOOKUP.search(ident[0]) else self._wrapped)(ident.end() + 1, parts)
            elif slot := _SLOT.match(text, at):
                parts.append(Part(-1, -1, slot[1] or slot[2]))
                at = slot.end()
            elif bare := _BARE.match(text, at):
                scheme = _SCHEME.match(text, at)
                if scheme and not parts:  # `Bearer`, then the credential
                    at = scheme.end()
                    bare, ident = _BARE.match(text, at) or bare, None
                value = bare[0].rstrip(".:")
                whole = ident is not None and ident[0] == value
                if value and (whole or not parts):
                    parts.append(Part(at, at + len(value), value if whole else None))
                at = bare.end()
            else:
                break
            joint = _JOINT.match(text, at)
            if not joint:
                break
            at = joint.end()
        return parts, at

    def _string(self, opened: re.Match, parts: list[Part]) -> int:
        """Append a string's place and the constants that it names; its end, or -1 if it isn't closed."""
        text, quote, start = self.text, opened["quote"], opened.end()
        escaped = text[opened.end("prefix"):opened.start("quote")] == "\\"
        at = start
        while True:
            close = text.find(quote, at)
            line = text.find("\n", at, close if close >= 0 else None) if len(quote) == 1 and quote != "`" else -1
            if close < 0 or line >= 0:
                return -1
            slashes = close - self._back(close, "\\")
            if escaped and slashes:
                close, end = close - slashes, close + 1
                break
            if slashes % 2 == 0 or escaped:
                end = close + len(quote)
                break
            at = close + 1
        template = "f" in opened["prefix"].lower() or quote == "`"
        last = start
        for slot in _SLOT.finditer(text, start, close):
            if template or slot[0][0] == "$":
                if slot.start() > last:
                    parts.append(Part(last, slot.start()))
                parts.append(Part(-1, -1, slot[1] or slot[2]))
                last = slot.end()
        if close > last:
            parts.append(Part(last, close))
        return end

    def _default(self, at: int, parts: list[Part]) -> int:
        """`get("NAME", default`: the default only."""
        first: list[Part] = []
        at = _GAP.match(self.text, at).end()
        opened = _OPEN.match(self.text, at)
        if not opened:
            return at
        end = self._string(opened, first)
        if end < 0:
            return at
        end = _GAP.match(self.text, end).end()
        if self.text[end:end + 1] != ",":
            return end
        return self._wrapped(end + 1, parts)

    def _wrapped(self, at: int, parts: list[Part]) -> int:
        """The first argument of a call: a string or a constant."""
        at = _GAP.match(self.text, at).end()
        opened = _OPEN.match(self.text, at)
        if opened:
            end = self._string(opened, parts)
            return end if end >= 0 else at
        ident = _IDENT.match(self.text, at)
        if ident and self.text[ident.end():ident.end() + 1] in (")", ","):
            parts.append(Part(-1, -1, ident[0]))
            return ident.end()
        return at


def _last(name: str) -> str:
    return re.split(r"\.|->|::", name)[-1]


def _reach(pairs: list[tuple[str, list[Part]]], known: set[str]) -> dict[str, float]:
    """For each constant, the greatest sensitivity of the targets that it flows to."""
    made_of: dict[str, list[str]] = {}
    weights: dict[str, float] = {}
    for name, parts in pairs:
        target = _last(name)
        made_of.setdefault(target, []).extend(c for p in parts if p.name and (c := _last(p.name)) in known and c != target)
        if made_of[target]:
            weights[target] = max(weights.get(target, 0.0), sensitivity(name))
    # the most sensitive targets first, so each constant is settled once: chains and circles take one pass
    reach: dict[str, float] = {}
    for target in sorted((t for t, w in weights.items() if w), key=weights.__getitem__, reverse=True):
        todo = list(made_of[target])
        while todo:
            constant = todo.pop()
            if constant not in reach:
                reach[constant] = weights[target]
                todo += made_of.get(constant, ())
    return reach


def _value(text: str, part: Part) -> tuple[int, int]:
    """A literal's place without blanks around it or the scheme of a credential."""
    start, end = part[:2]
    value = text[start:end]
    start += len(value) - len(value.lstrip())
    end -= len(value) - len(value.rstrip())
    scheme = _SCHEME.match(text, start, end)
    return (scheme.end() if scheme else start), end


def find(text: str | None) -> list[tuple[str, int, int, str | None, float | None]]:
    """Findings of a text: kind, start, end, target name and score, by start, then kind."""
    if not text:
        return []
    out = [("assign", m.start(), m.end(), m[1], None) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    known = [f[1:3] for f in out]
    out += [("access", *m.span(), None, None) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    out += [("hex", *m.span(), None, None) for m in HEX.finditer(text)]
    pairs = Lexer(text).pairs
    constants = {_last(name) for name, _ in pairs}
    reach = _reach(pairs, constants)
    best: dict[tuple[int, int], tuple[str, int, int, str, float]] = {}
    for name, parts in pairs:
        own, far = sensitivity(name), reach.get(_last(name), 0.0)
        if max(own, far) < THRESHOLD:
            continue
        for p in parts:
            if p.start < 0 or p.name and (_last(p.name) in constants or not re.search(r"\d", p.name)):
                continue  # a constant: its literal is reported where it stands
            place = _value(text, p)
            score = round(max(own, far) * randomness(text[place[0]:place[1]]), 6)
            had = best.get(place)
            if score >= THRESHOLD and (had is None or had[4] < score):
                best[place] = ("literal" if own >= far else "flow", *place, name, score)
    at = 0
    for finding in sorted(best.values(), key=lambda f: f[1:3]):
        while at < len(known) and known[at][1] < finding[2]:
            at += 1
        if at == len(known) or known[at][0] > finding[1]:
            out.append(finding)
    return sorted(out, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


_FINDING = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType()), T.StructField("name", T.StringType()),
                         T.StructField("score", T.DoubleType())])
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()),
                             ("score", pa.float64())]))


def _scanner(name: str, kept: list[str], out: str):
    keys = [f.name for f in _FINDING]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            texts = batch.column(batch.schema.get_field_index(name))
            found = pa.array([[dict(zip(keys, f, strict=True)) for f in find(t.as_py())] for t in texts], _ARROW)
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, found], [*kept, out])
    return lean(run)


def scan(docs: DataFrame, text_col: str = "text", out_col: str = "findings", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns (default: all) of every row and its findings: array of (kind, start, end, name, score)."""
    keep = without(docs.columns if keep is None else keep, out_col)
    alias = fresh(docs, "__text")
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(out_col, T.ArrayType(_FINDING))])
    return docs.select(*keep, F.col(text_col).alias(alias)).mapInArrow(_scanner(alias, keep, out_col), schema)


def count(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda f: f["kind"] == kind)).cast("long")


def spans(findings: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the findings of the kinds, joined by commas."""
    own = F.filter(findings, lambda f: f["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")
