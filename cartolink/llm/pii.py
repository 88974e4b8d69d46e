"""Personal data: fixed patterns, and a sequence tagger that adds what they miss.

Patterns are matched leftmost, without overlap within a kind; a match that fails
its check is dropped and not tried again.  The tagger (``tagger``: a
character-level bidirectional LSTM with CRF transitions) is trained here, from
labelled spans that a seeded generator writes into invented prose.  It reads
every character of every text in overlapping windows, whose evidence is joined
before one best path over the text is found.  Its spans are added where they
overlap no other and have the form of their kind.

Null texts count as empty and have no spans; ids are carried as they are, equal or
null, and repeated rows are read one by one.  Spans of two patterns may overlap and
both stay.  Long texts are read window by window; a batch holds some 500,000
characters, or one text.  Columns beside doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .tagger import Reader, Tagger, codes

KINDS = ("email", "ip", "card", "phone")
#: Labelled windows that the tagger learns from, their length, how often it reads
#: them, and the least mean lead over "no tag" of a span that it adds.
TRAIN_WINDOWS, TRAIN_STEPS, EPOCHS, LEAST_LEAD = 12_000, 72, 4, 1.0

# The base patterns, written so that no start is tried twice.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    past, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            past = m.end()
            yield start, past
        at = text.find("@", max(at + 1, past))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind, then start."""
    out = [(0, s, e) for s, e in _emails(text)]
    if DIGIT.search(text):
        out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


# -- labelled spans to learn from ----------------------------------------------

SYLLABLES = "an the ing ung she and edt ntha re in on er st en le ou ver und sch ein la que ción os de ra ñ é è ü ä ment ux tion ie ti ha ble".split()

LETTERS = "eeeeeettttaaaaooooiiinnnsssrrrhhhdddlluuccmmwwffggyyppbbvkjxqzéèñüäößç"


class _Writer:
    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def pick(self, items):
        return items[int(self.rng.integers(len(items)))]

    def digits(self, n: int) -> str:
        return "".join(map(str, self.rng.integers(0, 10, n)))

    def word(self) -> str:
        if self.rng.random() < 0.5:
            return "".join(self.pick(SYLLABLES) for _ in range(self.rng.integers(1, 5)))
        return "".join(self.pick(LETTERS) for _ in range(self.rng.integers(1, 12)))

    def filler(self) -> str:
        kind, w = self.rng.random(), self.word()
        if kind < 0.6:
            return w
        if kind < 0.7:
            return w.capitalize()
        if kind < 0.76:
            return w.upper() + self.pick(["", "!!", "!"])
        if kind < 0.82:
            return w + self.pick([",", ".", ";", ":", "###", "$$$", "&&&", "***", "%%%", " |", "@"])
        if kind < 0.88:
            return self.pick(["token", "key", "id", "password"]) + self.pick([" = ", "=", ": "]) + self.pick(["", '"']) + "".join(self.pick("0123456789abcdef") for _ in range(self.rng.integers(12, 40)))
        if kind < 0.91:
            return self.digits(self.rng.integers(1, 7)) + self.pick(["", "%", ".5", "th"])
        if kind < 0.94:
            return f"{self.rng.integers(1900, 2030)}-{self.rng.integers(1, 13):02}-{self.rng.integers(1, 29):02}" + self.pick(["", f" {self.rng.integers(24):02}:{self.rng.integers(60):02}:00"])
        if kind < 0.96:
            return f"v{self.rng.integers(10)}.{self.rng.integers(20)}" + self.pick(["", f".{self.rng.integers(20)}"])
        if kind < 0.98:
            return f"https://{w}.com/{self.word()}/{self.digits(4)}"
        return "AKIA" + "".join(self.pick("ABCDEFGHIJ0123456789") for _ in range(16))

    def email(self) -> str:
        local = self.pick([self.word(), f"{self.word()}.{self.word()}", f"{self.word()}.{self.digits(2)}", f"{self.word()}_{self.digits(1)}", f"{self.word()}+{self.word()}"])
        at, dot = self.pick([("@", ".")] * 8 + [(" [at] ", " [dot] "), ("(at)", "."), (" @ ", ".")])
        host = [self.pick(["mail", "post", self.word()]) + self.pick(["", self.digits(1)]), *self.pick([[], ["example"], [self.word()]]), self.pick(["com", "org", "de", "fr", "net", "es"])]
        return local + at + dot.join(host)

    def ip(self) -> str:
        return ".".join(str(x) for x in self.rng.integers(0, 256, 4))

    def card(self) -> str:
        cuts = self.pick([(4, 8, 12, 16)] * 3 + [(4, 10, 15)])
        d, sep = self.digits(cuts[-1] - 1), self.pick(["", "", "", " ", "-", ".", "/", "  ", " - "])
        d += next(c for c in "0123456789" if luhn(d + c))
        return sep.join(d[a:b] for a, b in zip((0, *cuts), cuts, strict=False))

    def phone(self) -> str:
        a, b, c = self.digits(3), self.digits(3), self.digits(4)
        return self.pick([f"+1 ({a}) {b}-{c}", f"+{self.digits(2)} {a} {b} {c}", f"+{self.digits(2)}{a}{b}{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1-{a}-{b}-{c}", f"00{self.digits(2)} {a} {b}{c}"])

    def window(self, steps: int) -> tuple[np.ndarray, np.ndarray]:
        text, tags, rate = "", [], self.pick([0.0, 0.03, 0.15])
        while len(text) < 2 * steps:
            if self.rng.random() < rate:
                k = int(self.rng.integers(4))
                piece, tag = (self.email, self.ip, self.card, self.phone)[k](), k + 1
            else:
                piece, tag = self.filler(), 0
            tail = self.pick([" "] * 8 + ["\n", ". ", ", ", " | ", "!! "])
            text += piece + tail
            tags += [tag] * len(piece) + [0] * len(tail)
        at = int(self.rng.integers(len(text) - steps))
        return codes(text)[at : at + steps], np.array(tags[at : at + steps])


def labelled(windows: int, steps: int = TRAIN_STEPS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(steps, windows) of codes and of tags: 0 none, then the kinds in order."""
    writer = _Writer(seed)
    x, y = zip(*(writer.window(steps) for _ in range(windows)), strict=True)
    return np.stack(x, 1), np.stack(y, 1)


@cache
def trained(windows: int = TRAIN_WINDOWS) -> Reader:
    tagger = Tagger(len(KINDS) + 1)
    tagger.fit(*labelled(windows), epochs=EPOCHS)
    return tagger.ready()


# -- spans ----------------------------------------------------------------------

DOT_WORDS = re.compile(r"@|\bat\b|[\[(]at[\])]", re.I)


def _has_form(kind: int, found: str) -> bool:
    digits = "".join(DIGIT.findall(found))
    if kind == 0:
        return bool(DOT_WORDS.search(found)) and bool(re.search(r"\w(?:\.|[\s\[(]+dot[\s\])]+)\w{2,}$", found, re.I)) and len(found) >= 7
    if any(c.isalpha() for c in found):
        return False
    if kind == 1:
        parts = re.findall(r"[0-9]+", found)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and bool(re.search(r"[^0-9]", found))


def all_spans(texts: list[str], reader: Reader) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """For each text (base spans, all spans), as (kind, start, end)."""
    out = []
    for text, added in zip(texts, reader.spans(reader.emissions([codes(t) for t in texts])), strict=True):
        base = base_spans(text)
        spans = list(base)
        # The tagger's spans come in order and overlap no other of theirs.
        taken = sorted((s, e) for _, s, e in base)
        starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
        for start, end, tag, lead in added:
            while start < end and not (text[start].isalnum() or text[start] in "+("):
                start += 1
            while end > start and not text[end - 1].isalnum():
                end -= 1
            before = bisect_left(starts, end)
            clear = not before or reach[before - 1] <= start
            if lead >= LEAST_LEAD and clear and start < end and _has_form(tag - 1, text[start:end]):
                # A span that stops inside a word or number is none.
                if not (text[start - 1 : start].isalnum() or text[end : end + 1].isalnum()):
                    spans.append((tag - 1, start, end))
        out.append((base, sorted(spans)))
    return out


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, reader: Reader | None = None) -> DataFrame:
    """(doc_id, text) -> doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts are those of the base spans.  No shuffle; the weights travel with
    the task, some tens of kB.
    """
    model = reader or trained()

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, ids, texts, size = [], batch["doc_id"].tolist(), [t if isinstance(t, str) else "" for t in batch["text"]], 0
            first = 0
            for at, text in enumerate(texts):
                size += len(text)
                if size >= 500_000 or at == len(texts) - 1:
                    for base, spans in all_spans(texts[first : at + 1], model):
                        counts = [sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))]
                        rows.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
                    first, size = at + 1, 0
            got = pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
            got.insert(0, "doc_id", pd.array([None if i is None or i != i else int(i) for i in ids], dtype="Int64"))
            yield got

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInPandas(digests, schema)
