"""Secret scan through a trigram inverted index.

Each rule's regular expression gives a Boolean trigram query.  For every run of
documents an index of the queried trigrams is built (trigram -> sorted document
numbers), the postings are intersected and united as the query says, and the
rule's expression runs over the candidates only.  A rule without a mandatory
trigram, such as the bare hexadecimal run, scans every document.  The index is
local to the documents it covers, so neither postings nor texts are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernels import lower_ascii, text_chunks
from .trigrams import trigram_query, trigrams_of


@dataclass(frozen=True)
class Rule:
    """A kind of secret: non-overlapping matches of ``pattern``, leftmost first,
    that are ``least`` characters long at least (or whose ``group`` is)."""
    kind: str
    pattern: str
    least: int = 1
    group: int = 0


# A private key reaches to the END line of its kind, or without one before the
# next header over the base64 lines that follow.  Every repeat is possessive and
# stops at the next header, so all matches of a text take linear time.
_LINE = r"(?:[\x20\t]*+(?:\r?\n|(?:\\r)?\\n)[\x20\t>]*+)"          # also the two characters \\n of a quoted text
_BASE64 = rf"[A-Za-z0-9+/]++={{0,2}}+(?={_LINE}|[\x20\t]*+(?:\Z|[\"'<]))"
PRIVATE_KEY = (
    r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----(?:"
    r"(?:[^-]++|-(?!----(?:BEGIN|END) [A-Z ]*PRIVATE KEY-----))*+-----END \1PRIVATE KEY-----|"
    rf"(?:{_LINE}(?:Proc-Type|DEK-Info|Comment|Version):[^\n\\]*+)*+(?:{_LINE}++{_BASE64})?+(?:{_LINE}{_BASE64})*+"
    r"(?:[\x20\t]++[A-Za-z0-9+/]{40,}+={0,2}+(?![^\s\"'<\\]))*+)")           # lines joined by spaces

BASE_RULES = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),             # the maximal runs, without visiting each short one
)
MORE_RULES = (
    Rule("private_key", PRIVATE_KEY),
    # only at the beginning of a run of its characters, so that each run is read once
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url_login", r"://[A-Za-z0-9._~%+-]+:[A-Za-z0-9._~%+!$-]+@"),
)
RULES = BASE_RULES + MORE_RULES
SPANS = "array<struct<kind:string,begin:int,finish:int>>"


class _Index:
    """Postings of the queried trigrams over one run of texts."""

    def __init__(self, trigrams: list[bytes]):
        self.number = {t: i + 1 for i, t in enumerate(trigrams)}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, i in self.number.items():
            self.table[int.from_bytes(t, "big")] = i

    def build(self, buf: np.ndarray, offs: np.ndarray) -> None:
        self.texts = len(offs) - 1
        b = lower_ascii(buf).astype(np.uint32)
        numbers = self.table[(b[:-2] << 16) | (b[1:-1] << 8) | b[2:]] if len(b) > 2 else np.zeros(0, np.uint16)
        at = np.flatnonzero(numbers)
        text = np.searchsorted(offs, at, "right") - 1
        whole = at + 2 < offs[text + 1]
        pairs = np.unique(numbers[at[whole]].astype(np.int64) * self.texts + text[whole])
        self.docs = pairs % max(1, self.texts)
        self.border = np.searchsorted(pairs // max(1, self.texts), np.arange(len(self.number) + 2))

    def find(self, query) -> np.ndarray:
        if query is None:
            return np.arange(self.texts)
        if isinstance(query, bytes):
            i = self.number[query]
            return self.docs[self.border[i]:self.border[i + 1]]
        merge = np.intersect1d if query[0] == "and" else np.union1d
        return reduce(merge, [self.find(q) for q in query[1]])


def _scanner(rules: tuple[Rule, ...]):
    """A function from an Arrow string array to each text's (start, rule number, end)."""
    queries = [trigram_query(r.pattern) for r in rules]
    index = _Index(sorted(set().union(*(trigrams_of(q) for q in queries))))
    compiled = [re.compile(r.pattern) for r in rules]

    def scan(texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        for lo, _, buf, offs in text_chunks(texts):
            index.build(buf, offs)
            decoded: dict[int, str] = {}
            for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
                for d in index.find(query).tolist():
                    if d not in decoded:
                        decoded[d] = buf[offs[d]:offs[d + 1]].tobytes().decode()
                    for m in compiled[k].finditer(decoded[d]):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            found[lo + d].append((m.start(), k, m.end()))
        for spans in found:
            spans.sort()
        return found
    return scan


def secret_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Array of (kind, begin, finish) in code points, by begin, then by the rules' order."""
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("finish", pa.int32())]))

    @F.arrow_udf(SPANS)
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = _scanner(rules)
        for texts in batches:
            yield pa.array([[{"kind": rules[k].kind, "begin": a, "finish": z} for a, k, z in spans] for spans in scan(texts)], spans_type)
    return compute.asNondeterministic()(text)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) of every row of ``docs`` (doc_id, text).

    A null text is empty and, like a text without secrets, has no spans.
    Repeated rows and null ids are kept as they are; other columns are ignored.
    Spans of different kinds may overlap; those of one kind never do.
    """
    return docs.select("doc_id", secret_spans(F.col("text"), rules).alias("spans"))


def redact(text: Column, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> Column:
    """The text with each maximal union of overlapping spans replaced by ``mark``; null stays null."""

    @F.arrow_udf("string")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = _scanner(rules)
        for texts in batches:
            out = texts.to_pylist()
            for i, spans in enumerate(scan(texts)):
                if not spans:
                    continue
                parts, upto, open_end = [], 0, -1
                for a, _, z in spans:
                    if a >= open_end:
                        parts += [out[i][upto:a], mark]
                    open_end = max(open_end, z)
                    upto = open_end
                out[i] = "".join(parts) + out[i][upto:]
            yield pa.array(out, pa.string())
    return compute(text)
