"""Phrases of words that stand together more often than their parts would by chance (operator 13).

Method: stripes. A prefix keys an associative counter of the words that follow it; stripes of one prefix are merged
element by element. The stripe of the empty prefix counts the words; a stripe of a phrase of k words counts its extensions
to k + 1 words. Everything asked for is read off merged stripes: an element is the frequency of an extension, the
frequency of a prefix is the element that it is itself one level below, and the largest element of a stripe tells whether
its prefix never stands without one and the same next word. A next word is named by the phrase that it ends one place on
(``next``), so an element knows its rest as well as its prefix, and the same maxima over ``next`` cover words in front.

Only phrases found ``least`` times matter, and all parts of such a phrase are as frequent, so level k + 1 counts only
places where the phrases of k words there and one place on are both frequent. Texts are coded once, in blocks of bounded
size without a shuffle; a block combines its own places, sends each distinct element once to the part of its stripe, and
gets back the numbers of the frequent ones. Words and phrases are compared exactly, by their bytes and by these numbers,
never by hashes. A stripe is dealt over ``SUB`` parts (the one of the empty prefix over all), so no frequent word's
followers gather in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm import frames, words
from martline.plans.scratch import new_folder

#: Bytes that end a piece, and bytes that end a word in it.
PIECE, BLANK = b".,;:!?\n\x0b\x0c\r", b" \t"
LEAST, LONGEST, TOP = 100, 5, 2000
#: Bytes of text that one block holds before it is sent, and parts that one stripe is dealt over.
BLOCK, SUB = 12 << 20, 32

_INSIDE = np.ones(256, bool)
_INSIDE[list(PIECE + BLANK)] = False
_ENDS = np.zeros(256, bool)
_ENDS[list(PIECE)] = True
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
#: A block's row without ``part`` holds its places, the rows with one its distinct elements in that part of their stripes.
_TABLE = "block long, lang string, part long, n long, words array<binary>, prefix binary, next binary, counts binary, at binary, element binary, parts binary"
_MERGED = "lang string, block long, part long, hits binary, numbers binary, id long, prefix long, next long, word binary, f long"


def _planes(values: np.ndarray, kind: type) -> bytes:
    """Integers byte by byte: first the lowest byte of all of them. The high bytes, mostly zero, then compress to nothing."""
    v = np.ascontiguousarray(values, kind)
    return v.view(np.uint8).reshape(len(v), v.itemsize).T.tobytes()


def _values(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _rising(values: np.ndarray, kind: type) -> bytes:
    """Integers in order as planes of their differences."""
    return _planes(np.diff(values, prepend=0), kind)


def _risen(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(_values(data, kind), dtype=np.int64)


def _placed(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in lower case and their places, which skip one wherever a piece or a text ends."""
    found = words.scan(texts, _INSIDE)
    if not len(found.starts):
        return pa.array([], pa.binary()), np.zeros(0, np.int64)
    inside = np.zeros(len(found.data) + 1, np.int8)
    inside[found.starts] += 1
    inside[found.ends] -= 1
    body = _LOWER[found.data[np.cumsum(inside[:-1]).astype(bool)]]
    size = found.ends - found.starts
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    ended = np.cumsum(_ENDS[found.data])[found.starts]
    text = np.repeat(np.arange(len(found.first) - 1), found.counts())
    cut = np.concatenate([[0], (ended[1:] != ended[:-1]) | (text[1:] != text[:-1])])
    made = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body.tobytes())])
    return made, np.arange(len(size)) + np.cumsum(cut)


def _rows(head: dict, names: pa.Array | None, prefix: np.ndarray, following: np.ndarray, counts: np.ndarray, at: np.ndarray, element: np.ndarray, ranges: int) -> list[dict]:
    """All rows of one block: its elements are numbered by part, prefix and next, so an answer names them by their place in the part's row."""
    part = _parts(names, prefix, following, ranges)
    order = np.argsort(part, kind="stable") if names is not None else np.lexsort((following, prefix, part))
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    parts, begin = np.unique(part[order], return_index=True)
    every = [head | {"at": _rising(at, np.int32), "element": _planes(number[element], np.int32), "parts": _planes(np.concatenate([parts, begin, [len(order)]]), np.int64)}]
    for p, own in zip(parts.tolist(), np.split(order, begin[1:]), strict=True):
        row = head | {"part": p, "n": None, "counts": _planes(counts[own], np.int64)}
        if names is not None:
            row |= {"words": names.take(pa.array(own)).to_pylist()}
        else:
            row |= {"prefix": _rising(prefix[own], np.int64), "next": _planes(following[own], np.int64)}
        every.append(row)
    return every


def _block(head: dict, parts: list[tuple[pa.Array, np.ndarray]], ranges: int) -> list[dict]:
    """The first rows of a block: the elements are distinct words, in the stripe of the empty prefix."""
    coded = pa.concat_arrays([w for w, _ in parts]).dictionary_encode()
    element = coded.indices.to_numpy()
    at, base = [], 0
    for _, places in parts:
        at.append(places + base)
        base += int(places[-1]) + 2
    none = np.zeros(0, np.int64)
    counts = np.bincount(element, minlength=len(coded.dictionary))
    return _rows(head | {"n": len(element)}, coded.dictionary, none, none, counts, np.concatenate(at), element, ranges)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}
    return pa.schema([(n, kinds[k]) for n, k in (f.split(" ") for f in ddl.split(", "))])


def blocks(docs: DataFrame, text: str, lang: str, ranges: int) -> DataFrame:
    """The first table of all blocks: a block is all words of the texts of one language in one part of a task."""
    from pyspark import TaskContext

    schema = _arrow(_TABLE)
    dealt = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text")).filter("text IS NOT NULL")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, {}, 0

        def sent() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for name in list(held):
                yield pa.RecordBatch.from_pylist(_block({"block": number, "lang": name}, held.pop(name), ranges), schema)
                number += 1

        for b in batches:
            for low, high in words.slices(b.column("text")):
                part = b.slice(low, high - low)
                named = part.column("lang").dictionary_encode()
                for k, name in enumerate(named.dictionary.to_pylist()):
                    mine = part.column("text").filter(pa.compute.equal(named.indices, k))
                    found, places = _placed(mine)
                    if len(found):
                        held.setdefault(name, []).append((found, places))
                        size += found.nbytes
                if size >= BLOCK:
                    yield from sent()
                    size = 0
        yield from sent()

    return dealt.mapInArrow(frames.per_task(each), _TABLE)


def _parts(names: pa.Array | None, prefix: np.ndarray, following: np.ndarray, ranges: int) -> np.ndarray:
    """The part of each element: by the word in the stripe of the empty prefix, else by prefix and a share of its stripe."""
    if names is not None:
        return np.fromiter((crc32(w) % ranges for w in names.to_pylist()), np.int64, len(names))
    share = words.mix(following.astype(np.uint64)) % np.uint64(SUB)
    return (words.mix(words.mix(prefix.astype(np.uint64)) + share) % np.uint64(ranges)).astype(np.int64)


def merged(table: DataFrame, least: int) -> DataFrame:
    """The stripes of each part, merged: their frequent elements (rows with ``id``), and for each block (rows with ``block``) which of those it sent are frequent, and their numbers."""
    schema = _arrow(_MERGED)

    def merge(group: pa.Table) -> pa.Table:
        sent = [_values(c, np.int64) for c in group["counts"].to_pylist()]
        counts, sizes = np.concatenate(sent), [len(c) for c in sent]
        lang, part = group["lang"][0].as_py(), group["part"][0].as_py()
        named = group["prefix"].null_count > 0
        if named:
            coded = group["words"].combine_chunks().flatten().dictionary_encode()
            element = coded.indices.to_numpy().astype(np.int64)
            first = np.unique(element, return_index=True)[1]
        else:
            prefix = np.concatenate([_risen(c, np.int64) for c in group["prefix"].to_pylist()])
            following = np.concatenate([_values(c, np.int64) for c in group["next"].to_pylist()])
            order = np.lexsort((following, prefix))
            p, n = prefix[order], following[order]
            new = np.concatenate([[True], (p[1:] != p[:-1]) | (n[1:] != n[:-1])])
            element = np.empty(len(order), np.int64)
            element[order] = np.cumsum(new) - 1
            first = order[new]
        f = np.zeros(len(first), np.int64)
        np.add.at(f, element, counts)
        often = np.flatnonzero(f >= least)
        number = np.full(len(f), -1, np.int64)
        number[often] = (part << 36) + np.arange(len(often))
        answers = {"block": [], "hits": [], "numbers": []}
        for block, own in zip(group["block"].to_pylist(), np.split(number[element], np.cumsum(sizes)[:-1]), strict=True):
            hit = np.flatnonzero(own >= 0)
            if len(hit):
                for k, v in zip(answers, (block, _rising(hit, np.int32), _planes(own[hit], np.int64)), strict=True):
                    answers[k].append(v)
        said = pa.table({k: pa.array(v, schema.field(k).type) for k, v in answers.items()} | {"part": pa.array([part] * len(answers["block"]), pa.int64())})
        found = {"id": pa.array(number[often]), "f": pa.array(f[often])}
        if named:
            found |= {"word": coded.dictionary.take(pa.array(often))}
        else:
            found |= {"prefix": pa.array(prefix[first[often]]), "next": pa.array(following[first[often]])}
        frames.trim()
        whole = [
            pa.table({c.name: pa.array([lang] * len(t), c.type) if c.name == "lang" else t[c.name] if c.name in t.column_names else pa.nulls(len(t), c.type) for c in schema})
            for t in (said, pa.table(found))
        ]
        return pa.concat_tables(whole)

    sent = table.filter("part IS NOT NULL").select("block", "lang", "part", "words", "prefix", "next", "counts")
    return sent.groupBy("lang", "part").applyInArrow(merge, _MERGED)


def _longer(table: DataFrame, answers: DataFrame, ranges: int) -> DataFrame:
    """The table one word on: where frequent elements stand at neighbouring places, each pair of them is an element."""
    schema = _arrow(_TABLE)

    def step(own: pa.Table, said: pa.Table) -> pa.Table:
        out = []
        for row in own.to_pylist() if len(said) else []:
            parts = _values(row["parts"], np.int64)
            begin = dict(zip(parts[: len(parts) // 2].tolist(), parts[len(parts) // 2 :].tolist(), strict=False))
            number = np.full(int(parts[-1]), -1, np.int64)
            for p, hits, n in zip(*(said[c].to_pylist() for c in ("part", "hits", "numbers")), strict=True):
                number[begin[p] + _risen(hits, np.int32)] = _values(n, np.int64)
            at, element = _risen(row["at"], np.int32), _values(row["element"], np.int32).astype(np.int64)
            kept = number[element] >= 0
            at, element = at[kept], element[kept]
            near = np.flatnonzero(at[1:] == at[:-1] + 1)
            if not len(near):
                continue
            pairs, back, counts = np.unique(element[near] * len(number) + element[near + 1], return_inverse=True, return_counts=True)
            head = {"block": row["block"], "lang": row["lang"]}
            out += _rows(head, None, number[pairs // len(number)], number[pairs % len(number)], counts, at[near], back, ranges)
        frames.trim()
        return pa.Table.from_pylist(out, schema)

    state = table.filter("part IS NULL").select("block", "lang", "at", "element", "parts")
    return state.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(step, _TABLE)


def _named(level: DataFrame, below: DataFrame | None) -> DataFrame:
    """``lang, id, a, phrase, last``, and the frequencies ``firsts`` and ``lasts`` of the first and last 1, 2, ... words."""
    f = F.array("f")
    if below is None:
        word = F.col("word").cast("string")
        return level.select("lang", "id", F.col("f").alias("a"), word.alias("phrase"), word.alias("last"), f.alias("firsts"), f.alias("lasts"), "prefix", "next")
    head = below.select("lang", F.col("id").alias("prefix"), F.col("phrase").alias("head"), "firsts")
    rest = below.select("lang", F.col("id").alias("next"), "last", "lasts")
    both = level.join(head, ["lang", "prefix"]).join(rest, ["lang", "next"])
    return both.select(
        "lang", "id", F.col("f").alias("a"), F.concat_ws(" ", "head", "last").alias("phrase"), "last",
        F.concat("firsts", f).alias("firsts"), F.concat("lasts", f).alias("lasts"), "prefix", "next",
    )


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """All words and phrases up to ``longest`` words found ``least`` times or more in a language (``lang, words, phrase, a,
    firsts, lasts``, and ``longer``, the largest frequency of a phrase that has one word more), and ``lang, n``, all words."""
    spark = docs.sparkSession
    frames.ready(spark)
    ranges = frames.width(spark)
    folder = new_folder(spark)
    table = frames.written(blocks(docs, text, lang, ranges), folder)
    n = frames.written(table.groupBy("lang").agg(F.sum("n").alias("n")))
    levels: list[DataFrame] = []
    for k in range(1, longest + 1):
        done = frames.written(merged(table, least), f"{folder}-merged")
        found = done.filter("id IS NOT NULL")
        levels.append(frames.written(_named(found, levels[-1] if levels else None)))
        used = [folder, f"{folder}-merged"]
        if k < longest:
            answers = done.filter("block IS NOT NULL").select("block", "part", "hits", "numbers")
            folder = new_folder(spark)
            table = frames.written(_longer(table, answers, ranges), folder)
        for f in used:
            frames.removed(spark, f)
    out = []
    for k, level in enumerate(levels, 1):
        more = levels[k] if k < longest else level.limit(0)
        above = more.select("lang", F.col("prefix").alias("id"), "a").union(more.select("lang", F.col("next").alias("id"), "a"))
        above = above.groupBy("lang", "id").agg(F.max("a").alias("longer"))
        out.append(level.join(above, ["lang", "id"], "left").select("lang", F.lit(k).alias("words"), "phrase", "a", "firsts", "lasts", "longer"))
    return reduce(DataFrame.union, out), n


def scored(found: DataFrame, n: DataFrame) -> DataFrame:
    """Phrases of two words or more with the cut of lowest score: ``l``, ``r``, ``n``, ``score``. Decimals of 38 digits hold every product."""
    wide = T.DecimalType(19, 0)

    def cut(k):
        first, rest = F.get("firsts", k - 1), F.get("lasts", F.col("words") - k - 1)
        return F.struct(F.expr("bigint(1000)").cast(wide).alias("m"), k.alias("k"), first.alias("l"), rest.alias("r"))

    both = found.filter("words > 1").join(n, "lang")
    cuts = both.withColumn("cut", F.explode(F.transform(F.sequence(F.lit(1), F.col("words") - 1), cut)))
    score = F.expr("(CAST(a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0)) * cut.m) div (CAST(cut.l AS DECIMAL(19,0)) * CAST(cut.r AS DECIMAL(19,0)))")
    least = cuts.groupBy("lang", "phrase", "a", "n", "longer").agg(F.min(F.struct(score.alias("score"), F.col("cut.k"), F.col("cut.l"), F.col("cut.r"))).alias("c"))
    return least.select("lang", "phrase", "a", "longer", "c.l", "c.r", "n", "c.score")


def ranked(found: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language: first of each of many shares of its phrases, then of what these leave."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = found.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    few = share.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).filter(F.col("rank") <= top)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` is the phrase's frequency, ``l`` and ``r`` those of its two parts at the cut of lowest score, ``n`` all words of
    the language. A phrase that is never found outside one longer phrase of ``longest`` words or less is left out. Null
    and empty texts have no words, a null language is ``und``, repeated rows count each. Other columns play no part.
    An empty table has no phrases. A block's words must fit in a worker's memory, about 12 MB of text or one longer text.
    """
    found, n = phrases(docs, text, lang, least, longest)
    alone = found.filter("longer IS NULL OR longer < a")
    return ranked(scored(alone, n), top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    """Operator 13 over ``documents``."""
    return collocations(frames.table(spark, sf_dir, "documents"))


SQL = r"""
WITH pieces AS (
  SELECT doc_id, lang, unnest(ps) AS piece, unnest(range(len(ps))) AS p FROM (
    SELECT doc_id, coalesce(lang, 'und') AS lang,
      regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents)
), lists AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces
), places AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM lists WHERE len(ws) > 0
), grams AS (
  SELECT lang, ws[i:i + k - 1] AS g, k FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS k FROM places) WHERE i + k - 1 <= len(ws)
), f AS (
  SELECT lang, g, k, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100
), n AS (
  SELECT lang, count(*) AS n FROM places GROUP BY lang
), longer AS (
  SELECT lang, part, max(a) AS a FROM (
    SELECT lang, g[1:k - 1] AS part, a FROM f WHERE k > 2 UNION ALL SELECT lang, g[2:k] AS part, a FROM f WHERE k > 2) GROUP BY ALL
), alone AS (
  SELECT f.* FROM f LEFT JOIN longer m ON m.lang = f.lang AND m.part = f.g WHERE f.k > 1 AND (m.a IS NULL OR m.a < f.a)
), cuts AS (
  SELECT lang, g, k, a, unnest(range(1, k)) AS c FROM alone
), scores AS (
  SELECT u.lang, u.g, u.a, u.c, l.a AS l, r.a AS r, n.n, (1000::HUGEINT * u.a * n.n) // (l.a::HUGEINT * r.a) AS score
  FROM cuts u JOIN f l ON l.lang = u.lang AND l.g = u.g[1:u.c] JOIN f r ON r.lang = u.lang AND r.g = u.g[u.c + 1:u.k] JOIN n ON n.lang = u.lang
), best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1
), named AS (
  SELECT *, array_to_string(g, ' ') AS phrase FROM best
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM named QUALIFY rank <= 2000
"""
