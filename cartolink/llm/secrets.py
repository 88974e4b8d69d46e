"""Secret scan with one combined deterministic automaton.

All rules are compiled together (``automaton``) and every text is read byte by
byte once.  Where the automaton reports that a rule's match ends, the rule's own
reversed automaton finds where it began and its forward one how far it goes.
Matches of a rule are leftmost, longest and do not overlap; those that are too
short are dropped and nothing is tried again inside them.  The leftmost start is
exact for rules of which no match can begin inside another's fixed first part,
as holds for all rules here.

Null texts count as empty.  Ids are carried as they are, equal or null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame

from .automaton import compile_rules


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int  #: characters
    value: bool = False  #: ``least`` is for what follows the separator


# The three base rules' patterns and lengths, in the order in which
# spans with equal starts are listed, then published formats of access keys.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 6, value=True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{6,}", 24),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 24),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", 24),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 27),
)
BASE = 3


def _value(match: bytes) -> int:
    """Length of what an assignment assigns."""
    at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    rest = match[at + 1 :].lstrip(b" ")
    return len(rest) - (rest[:1] in (b'"', b"'"))


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.all = compile_rules([r.pattern for r in rules], anywhere=True)
        self.start = self.all.rows[0]
        self.own = [(compile_rules([r.pattern]).rows[0], compile_rules([r.pattern], backward=True).rows[0]) for r in rules]

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """(end, bits of the rules that match up to it), in one pass."""
        row, found = self.start, []
        for at, byte in enumerate(data, 1):
            row = row[byte]
            if row[256]:
                found.append((at, row[256]))
        return found

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, rule, end) in code points, by start, then rule."""
        data, found = text.encode("utf-8", "surrogatepass"), []
        past = [0] * len(self.rules)
        for end, bits in self.ends(data):
            for k in range(bits.bit_length()):
                if not bits >> k & 1 or end <= past[k]:
                    continue
                forward, back = self.own[k]
                start, row, at = -1, back, end
                while at > past[k]:
                    at -= 1
                    row = row[data[at]]
                    if row[256]:
                        start = at
                    elif row[0] is row and row[97] is row and row[255] is row:
                        break  # no way on from here
                if start < 0:
                    continue
                row, at = forward, start
                while at < len(data):
                    row = row[data[at]]
                    at += 1
                    if row[256]:
                        past[k] = at
                    elif at >= end:
                        break
                match = data[start : past[k]]
                if (_value(match) if self.rules[k].value else len(match)) >= self.rules[k].least:
                    found.append((start, k, past[k]))
        if len(data) != len(text):
            point = lambda at: len(data[:at].decode("utf-8", "surrogatepass"))
            found = [(point(s), k, point(e)) for s, k, e in found]
        return sorted(found)


@cache
def scanner() -> Scanner:
    return Scanner()


def listed(rules: tuple[Rule, ...], spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{rules[k].kind}:{s}:{e}" for s, k, e in spans)


def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    find, rules = scanner(), RULES
    for batch in batches:
        out = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            spans = find.spans(text) if isinstance(text, str) else []
            base = [x for x in spans if x[1] < BASE]
            counts = [sum(x[1] == k for x in base) for k in range(BASE)]
            digest = hashlib.sha256(listed(rules, base).encode()).hexdigest()
            out.append((doc_id, *counts, digest, listed(rules, spans)))
        got = pd.DataFrame(out, columns=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
        yield got.assign(doc_id=got["doc_id"].astype("Int64"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, n_assign, n_access, n_hex, base_sha256, spans.  No shuffle."""
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInPandas(
        digests, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
