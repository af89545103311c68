"""Secret scans with a trigram inverted index.

Each rule's regular expression is parsed (by Python's own parser) into a Boolean query over trigrams that any match
must contain; letters in either case are folded.  Every slice of an Arrow batch gets its own inverted index: postings
of those trigrams that some rule asks for.  A rule's query intersects and unites postings, and only the documents that
remain are verified with the expression itself.  A rule without mandatory trigrams scans every document.

Offsets are code points, end exclusive.  Within a kind, matches are leftmost and do not overlap; a match that fails
its length test is dropped after it has consumed its text.

Defined results: null and empty texts have no spans; texts without spans keep their row with empty lists; repeated rows
are scanned each for itself; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, doc_text, parts_by_size, slices


@dataclass(frozen=True)
class SecretRule:
    """group and at_least: that group of a match must have so many characters.  flags: of re, besides ASCII."""

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 0
    flags: int = 0


#: The three base rules, in their order.
BASE_RULES = (
    SecretRule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, re.I),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    SecretRule("hex", r"[0-9a-f]+", 0, 24),
)
#: Rules that the method adds: well-known public forms of credentials.
MORE_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"),
    SecretRule("git_token", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    SecretRule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    SecretRule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,200}:[^\s/@]{1,200}@"),
)
RULES = BASE_RULES + MORE_RULES

ALL = None  # the query that any text meets


def _and(a, b):
    return b if a is ALL else a if b is ALL else ("and", a, b)


def _or(a, b):
    return ALL if a is ALL or b is ALL else a if a == b else ("or", a, b)


def _of_string(s: str):
    query = ALL
    for gram in dict.fromkeys(s[i : i + 3] for i in range(len(s) - 2)):
        query = _and(query, gram)
    return query


class _Info:
    """exact: the (folded) strings a part can match, if few; else prefixes and suffixes of two characters and a query."""

    def __init__(self, exact=None, query=ALL):
        self.exact, self.query = exact, query

    def settled(self):
        """The query alone.  A string that holds another one of the set asks for nothing more than that one."""
        if self.exact is None:
            return self.query
        out, first = ALL, True
        for s in sorted(x for x in self.exact if not any(y != x and y in x for y in self.exact)):
            q = _of_string(s)
            out, first = (q, False) if first else (_or(out, q), False)
        return _and(self.query, out)


FEW = 40


def _analyse(parsed) -> _Info:
    from re import _constants as c

    done, run = ALL, _Info({""})

    def close():
        nonlocal done, run
        done, run = _and(done, run.settled()), _Info({""})

    for op, arg in parsed:
        if op is c.LITERAL:
            part = _Info({chr(arg).lower()})
        elif op is c.IN:
            chars = _class_chars(arg)
            part = _Info({x.lower() for x in chars}) if chars is not None and len({x.lower() for x in chars}) <= 8 else _Info(None)
        elif op is c.SUBPATTERN:
            part = _analyse(arg[3])
        elif op is c.BRANCH:
            parts = [_analyse(p) for p in arg[1]]
            if all(p.exact is not None for p in parts) and sum(len(p.exact) for p in parts) <= FEW and all(p.query is ALL for p in parts):
                part = _Info(set().union(*(p.exact for p in parts)))
            else:
                query = parts[0].settled()
                for p in parts[1:]:
                    query = _or(query, p.settled())
                part = _Info(None, query)
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT, c.POSSESSIVE_REPEAT):
            low, high, body = arg
            inner = _analyse(body)
            if (low, high) == (0, 1) and inner.exact is not None and inner.query is ALL:
                part = _Info(inner.exact | {""})
            elif low >= 1:
                part = _Info(None, inner.settled())
            else:
                part = _Info(None)
        elif op in (c.AT, c.ASSERT, c.ASSERT_NOT):
            continue
        else:
            part = _Info(None)
        if part.exact is not None and run.exact is not None and len(part.exact) * len(run.exact) <= FEW:
            run = _Info({a + b for a in run.exact for b in part.exact}, _and(run.query, part.query))
        else:
            close()
            if part.exact is not None:
                run = part
            else:
                done = _and(done, part.query)
    if done is ALL:
        return run
    return _Info(None, _and(done, run.settled()))


def _class_chars(items):
    from re import _constants as c

    out: set[str] = set()
    for op, arg in items:
        if op is c.LITERAL:
            out.add(chr(arg))
        elif op is c.RANGE and arg[1] - arg[0] < 64:
            out.update(map(chr, range(arg[0], arg[1] + 1)))
        else:
            return None
    return out


def trigram_query(pattern: str):
    """None (any text), a trigram, or ("and" | "or", query, query)."""
    from re import _parser

    return _analyse(_parser.parse(pattern)).settled()


def trigrams_of(query) -> set[str]:
    if query is ALL:
        return set()
    return {query} if isinstance(query, str) else trigrams_of(query[1]) | trigrams_of(query[2])


#: Bytes whose trigrams are looked up at once.
SCANNED = 1 << 20


class Scanner:
    def __init__(self, rules: tuple[SecretRule, ...] = RULES):
        self.rules = rules
        self.compiled = [re.compile(r.pattern, r.flags | re.ASCII) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        grams = sorted({t for q in self.queries for t in trigrams_of(q)})
        if any(len(t.encode()) != 3 for t in grams):
            raise ValueError("only ASCII trigrams are indexed")
        self.slot = {t: i + 1 for i, t in enumerate(grams)}
        self.lookup = np.zeros(1 << 24, np.uint8 if len(grams) < 255 else np.uint16)
        for t, i in self.slot.items():
            a, b, c = t.encode()
            self.lookup[a << 16 | b << 8 | c] = i

    def postings(self, texts: list[str]) -> dict[int, np.ndarray]:
        """Trigram slot -> sorted numbers of the texts that hold it, letters folded."""
        folded = [t.encode().lower() for t in texts]
        buffer, ends = np.frombuffer(b"\x00\x00".join(folded), np.uint8), np.cumsum([len(f) + 2 for f in folded])
        found = [np.zeros(0, np.int64)]
        for start in range(0, len(buffer) - 2, SCANNED):
            part = buffer[start : start + SCANNED + 2]
            code = part[:-2].astype(np.int32) << 16
            code |= part[1:-1].astype(np.int32) << 8
            code |= part[2:]
            slots = self.lookup[code]
            at = np.flatnonzero(slots)
            found.append(np.unique(slots[at].astype(np.int64) * len(texts) + np.searchsorted(ends, at + start, side="right")))
        pairs = np.unique(np.concatenate(found))
        which = pairs // len(texts)
        return {int(s): pairs[which == s] % len(texts) for s in np.unique(which)}

    def candidates(self, query, index: dict[int, np.ndarray], n: int) -> np.ndarray:
        if query is ALL:
            return np.arange(n)
        if isinstance(query, str):
            return index.get(self.slot[query], np.zeros(0, np.int64))
        a = self.candidates(query[1], index, n)
        if query[0] == "and":
            return np.intersect1d(a, self.candidates(query[2], index, n), assume_unique=True) if len(a) else a
        return np.union1d(a, self.candidates(query[2], index, n))

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text its spans (start, rule number, end), sorted."""
        out: list[list] = [[] for _ in texts]
        index = self.postings(texts)
        for k, (rule, regex, query) in enumerate(zip(self.rules, self.compiled, self.queries, strict=True)):
            for i in self.candidates(query, index, len(texts)).tolist():
                for m in regex.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.at_least:
                        out[i].append((m.start(), k, m.end()))
        for spans in out:
            spans.sort()
        return out


@lru_cache(maxsize=2)
def scanner(rules: tuple[SecretRule, ...] = RULES) -> Scanner:
    return Scanner(rules)


def scan(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """doc_id, spans array<struct<kind, start, end>> sorted by start and rule."""

    def run(batches):
        import pyarrow as pa

        one = scanner(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in slices(batch):
                found = one.scan(part.column(1).to_pylist())
                spans = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in x] for x in found]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    return doc_text(docs).mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def digests(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds and the spans as text, from scan()."""
    base = [r.kind for r in BASE_RULES]

    def text(c):
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return scan(docs).select("doc_id", *map(count, base), F.sha2(text(of_base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def redact_text(text: str, spans, mark: str = "[{kind}]") -> str:
    """Spans replaced by their kind's mark; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], mark.format(kind=kind)]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """docs with every span replaced by ``[kind]``; null stays null, other columns stay as they are."""

    @F.pandas_udf("string")
    def run(texts):
        import pandas as pd

        one, out = scanner(rules), []
        every = texts.tolist()
        for at, to in parts_by_size(every):
            part = every[at:to]
            found = one.scan([t or "" for t in part])
            out += [t if t is None or not x else redact_text(t, [(rules[k].kind, a, b) for a, k, b in x]) for t, x in zip(part, found, strict=True)]
        return pd.Series(out, dtype=object)

    return bounded_batches(docs).withColumn(text_col, run(F.col(f"`{text_col}`")))
