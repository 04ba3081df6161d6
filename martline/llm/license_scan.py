"""Licence texts and notices in documents (operator 11).

Method: one generalised suffix automaton holds the words of all licence templates. A document is streamed through it;
after each word the automaton's state and length are the longest ending here that stands in any template (matching
statistics). Lengths that the next word does not extend are maximal matches; those of ``MIN_MATCH`` words or more are
placed in the templates by the positions stored with their states, and chained per template in the order of both texts.
A chain covers a span of the document and a share of its template, so changed, missing and added words only cost what
they are. Phrases that name a licence are strings of the same automaton: every place of one is found from the state there.

Words are compared exactly. A document costs time in line with its words: a state has few positions at that length, and
a chain looks back over ``MAX_GAP`` words only. Documents are independent, so nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm import frames
from martline.llm.license_texts import TEXTS

#: Phrases that name a licence, and its label.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Words of a match that takes part in a chain, and words of the document that may lie between two matches of one.
MIN_MATCH, MAX_GAP = 4, 40
#: Share of a template that a span covers to be reported, and to give its label.
LEAST_SPAN, LEAST_COVER = 0.3, 0.75
#: Words at which a complete match counts half.
HALF_SURE = 4
#: Bytes of a text that are split into words at a time.
_BLOCK = 1 << 20

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def split(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in lower case: letters a-z, digits and all that is not ASCII; long texts in blocks."""
    body = text.translate(_TABLE)
    at = 0
    while at < len(body):
        end = body.find(b" ", at + _BLOCK)
        end = len(body) if end < 0 else end
        yield body[at:end].split()
        at = end


def word_list(text: str) -> list[bytes]:
    return [w for part in split(text.encode()) for w in part]


@dataclass
class Automaton:
    """Generalised suffix automaton. Of each state: transitions, suffix link, longest length, (text, end) of its own and of all its occurrences."""

    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    places: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])

    def _state(self, length: int, to: dict[int, int], link: int) -> int:
        self.next.append(to)
        self.link.append(link)
        self.length.append(length)
        self.places.append([])
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A state for the strings of ``q`` that are no longer than what reaches it from ``p``."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extended(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # known from another text
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def add(self, number: int, codes: Sequence[int]) -> None:
        last = 0
        for end, c in enumerate(codes, 1):
            last = self._extended(last, c)
            self.places[last].append((number, end))

    def close(self) -> None:
        """Hand the occurrences of each state to the shorter strings that end alike."""
        for v in sorted(range(1, len(self.link)), key=lambda v: -self.length[v]):
            if self.link[v] > 0:
                self.places[self.link[v]].extend(self.places[v])


class Scanner:
    """The automaton of templates and phrases, and the spans that it finds in a document."""

    def __init__(self, texts: Sequence[tuple[str, str, str]], phrases: Sequence[tuple[str, str]]):
        self.texts = texts
        self.labels = [label for _, label in phrases]
        lists = [word_list(t) for _, _, t in texts]
        named = [word_list(p) for p, _ in phrases]
        self.code = {w: k for k, w in enumerate(sorted({w for ws in (*lists, *named) for w in ws}))}
        self.sizes = [len(ws) for ws in lists]
        self.automaton = a = Automaton()
        for k, ws in enumerate((*lists, *named)):
            a.add(k, [self.code[w] for w in ws])
        a.close()
        # a state stands for the phrases that end its longest string: its own one and those of its link
        of_phrase = [self._state_of(ws) for ws in named]
        self.named: list[list[tuple[int, int]]] = [[] for _ in a.link]
        for v in sorted(range(1, len(a.link)), key=lambda v: a.length[v]):
            self.named[v] = self.named[a.link[v]] + [(k, len(ws)) for k, ws in enumerate(named) if of_phrase[k] == v]
        self.placed = [sorted((k, end) for k, end in places if k < len(lists)) for places in a.places]

    def _state_of(self, string: list[bytes]) -> int:
        state = 0
        for w in string:
            state = self.automaton.next[state][self.code[w]]
        return state

    def matches(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int]]]:
        """Words, places of phrases (phrase, start) and maximal matches (end, length, state) of a document."""
        code, step, link, length, named = self.code.get, self.automaton.next, self.automaton.link, self.automaton.length, self.named
        found, long = [], []
        v = n = at = 0
        for part in split(text):
            for w in part:
                at += 1
                c = code(w, -1)
                to = step[v].get(c)
                if to is None:
                    if n >= MIN_MATCH:
                        long.append((at - 1, n, v))
                    if c < 0:
                        v = n = 0
                        continue
                    while to is None and v:
                        v = link[v]
                        to = step[v].get(c)
                    n = length[v]
                    if to is None:
                        continue
                v = to
                n += 1
                if named[v]:
                    found.extend((k, at - size) for k, size in named[v] if size <= n)
        if n >= MIN_MATCH:
            long.append((at, n, v))
        return at, found, long

    def spans(self, long: list[tuple[int, int, int]]) -> list[dict]:
        """Chains of matches that cover ``LEAST_SPAN`` of a template, the best ones first where spans overlap; in the order of the document."""
        of_text: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for end, n, v in long:
            for k, template_end in self.placed[v]:
                of_text[k].append((end, template_end, n))
        chains = [c for k, own in of_text.items() for c in self._chains(k, own)]
        kept: list[dict] = []
        taken: list[tuple[int, int]] = []
        for c in sorted(chains, key=lambda c: (c["lost"] - c["covered"], c["start"], c["template"])):
            if _free(taken, c["start"], c["end"]):
                kept.append(c)
        return [{k: c[k] for k, _ in _SPAN} for c in sorted(kept, key=lambda c: c["start"])]

    def _chains(self, k: int, own: list[tuple[int, int, int]]) -> list[dict]:
        """The chains of one template: each match goes on from the earlier one near it that leaves most words covered."""
        own.sort()
        best: list[tuple[int, int, int]] = []  # words covered, first match, and whether it is continued
        follows = [False] * len(own)
        low, longest = 0, max(n for _, _, n in own)
        for m, (end, template_end, n) in enumerate(own):
            while own[low][0] < end - longest - MAX_GAP:
                low += 1
            covered, first, before = n, m, -1
            for j in range(low, m):
                end_j, template_j, _ = own[j]
                if end_j < end and template_j < template_end and end - n - end_j <= MAX_GAP:
                    more = best[j][0] + min(n, end - end_j, template_end - template_j)
                    if more > covered:
                        covered, first, before = more, best[j][1], j
            if before >= 0:
                follows[before] = True
            best.append((covered, first, before))
        label, name, _ = self.texts[k]
        out = []
        for m, (covered, first, _) in enumerate(best):
            share = min(1.0, covered / self.sizes[k])
            if not follows[m] and share >= LEAST_SPAN:
                start, end = own[first][0] - own[first][2], own[m][0]
                lost = (self.sizes[k] - covered) + (end - start - covered)
                out.append({"label": label, "template": name, "start": start, "end": end, "covered": covered, "coverage": round(share, 6), "lost": lost})
        return out


def _free(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether no taken range overlaps; if so the range is taken."""
    from bisect import bisect_left, insort

    k = bisect_left(taken, (start, end))
    if (k < len(taken) and taken[k][0] < end) or (k and taken[k - 1][1] > start):
        return False
    insort(taken, (start, end))
    return True


_SPAN = [("label", pa.string()), ("template", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()), ("coverage", pa.float64())]
_MADE = [
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("named", pa.list_(pa.string())), ("spans", pa.list_(pa.struct(_SPAN))),
]
_KINDS = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "named": "array<string>"}
_KINDS["spans"] = "array<struct<label string, template string, start long, end long, covered long, coverage double>>"
#: Columns that this operator adds.
MADE = tuple(_KINDS)


def found_in(text: bytes, scanner: Scanner) -> tuple:
    """The values of ``MADE`` for one document."""
    n, places, long = scanner.matches(text)
    starts = [s for _, s in places]
    named = sorted({scanner.labels[k] for k, _ in places})
    return n, len(places), min(starts, default=None), max(starts, default=None), named, scanner.spans(long)


def scan(docs: DataFrame, text: str = "text", texts: Sequence[tuple[str, str, str]] = TEXTS, phrases: Sequence[tuple[str, str]] = PHRASES, carry: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (of it the columns ``carry``, if given) with ``n_words``, the places of ``phrases`` (``n_base``, the least and
    largest start ``first_word`` and ``last_word``, labels ``named``) and ``spans`` of ``texts``: ``label, template, start,
    end`` (words from 0, end excluded), words ``covered`` and the share ``coverage`` of the template.

    Where spans overlap the one that covers most and leaves least out stays. Null and empty texts have no words and no
    spans; repeated rows are each scanned; columns of these names in ``docs`` are replaced.
    """
    frames.ready(docs.sparkSession)
    columns = list(docs.columns if carry is None else carry)
    dealt = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([dealt.schema["row"], *T.StructType.fromDDL(", ".join(f"{n} {k}" for n, k in _KINDS.items()))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(texts, phrases)
        for b in batches:
            rows = [found_in((t.as_buffer().to_pybytes() if t.is_valid else b""), scanner) for t in b.column("text")]
            made = [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(_MADE)]
            yield pa.RecordBatch.from_arrays([b.column("row"), *made], ["row", *MADE])

    return frames.unpacked(dealt.mapInArrow(frames.per_task(each), schema), columns, *MADE)


def labels(least: float = LEAST_COVER) -> Column:
    """All labels of a scanned document: named ones and those of spans that cover ``least`` of their template."""
    spans = F.transform(F.filter("spans", lambda s: s["coverage"] >= least), lambda s: s["label"])
    return F.array_sort(F.array_distinct(F.concat("named", spans)))


def score(phrases: Sequence[tuple[str, str]] = PHRASES) -> Column:
    """0 to 1: the coverage of the best span, less the shorter it is. A named licence counts as a span of its phrase, the shortest one of ``phrases`` for all."""
    shortest = min((len(word_list(p)) for p, _ in phrases), default=1)
    spans = F.transform("spans", lambda s: s["coverage"] * s["covered"] / (s["covered"] + HALF_SURE))
    named = F.when(F.col("n_base") > 0, F.lit(shortest / (shortest + HALF_SURE)))
    return F.round(F.greatest(F.coalesce(F.array_max(spans), F.lit(0.0)), F.coalesce(named, F.lit(0.0))), 6)


def op11_license_scan(spark, sf_dir: str) -> DataFrame:
    """Operator 11 over ``documents``, with the best spans' template and words beside the labels."""
    done = scan(frames.table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return done.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("named", ",").alias("base_labels"),
        F.array_join(labels(), ",").alias("labels"), score().alias("score"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["template"], s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
    )
