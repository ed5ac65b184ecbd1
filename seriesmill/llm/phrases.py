"""Collocations by SON partitioning: shards mined completely at lowered support, then one exact global count.

Documents are dealt to shards by a hash of their id. A phrase that occurs ``least`` times in a language reaches, in at
least one shard, ``least`` times the shard's share of the language, rounded up (the shares add up to one): that is the local support.
A shard is mined by many tasks: chunks count hashed word sequences, and ranges of the hashes add them up
and keep those with local support. Their union marks a bitmap of fixed size. The second scan counts, by their words and
not by hashes, all sequences that the bitmap may name; a sequence marked by a collision only costs a row. A fuller bitmap
(very many frequent phrases) sets aside less and changes no result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm.work import Work

LEAST, LONGEST, TOP = 30, 4, 2_000
SHARDS = 4
#: Text bytes of a chunk, and of a piece of a longer text.
CHUNK, SEGMENT = 3 << 20, 2 << 20
#: Sequences of a range of one shard that one task adds up, as planned from text bytes (about 0.5 different ones a byte).
RANGE = 2 << 20
#: Bits of a sequence hash, of the bitmap and of one of its rows.
HASH_BITS, MAP_BITS, ROW_BITS = 48, 27, 15
#: Shares of a language's phrases that are ranked apart before they are ranked together.
SALTS = 64

_BREAK = b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[[32, 9]] = 1
_KIND[list(_BREAK)] = 2
_DELIMITER = re.compile(rb"[ \t.,;:!?\n-\r]")
_AHEAD = re.compile(rb"(?:[ \t]+[^ \t.,;:!?\n-\r]+){0,%d}" % (LONGEST - 1))


def segments(text: bytes, size: int = SEGMENT) -> Iterator[tuple[bytes, int]]:
    """A text in parts that end with a word, each with the words that its last sequences need, and the bytes that are its own."""
    at = 0
    while len(text) - at > size:
        end = _DELIMITER.search(text, at + size)
        if end is None:
            break
        yield text[at : _AHEAD.match(text, end.start()).end()], end.start() - at
        at = end.start()
    yield (text[at:] if at else text), len(text) - at


class Words:
    """The words of some text parts: dictionary, and per word its number in it, its part, and how long a sequence may start with it."""

    def __init__(self, parts: list[tuple[bytes, int]]) -> None:
        data = b"\n".join(p for p, _ in parts).lower()  # of bytes, only A-Z change
        raw = np.frombuffer(data + b"\n", np.uint8)
        kind = _KIND[raw]
        word = kind == 0
        edge = np.diff(word.astype(np.int8), prepend=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        firsts = np.cumsum([0, *(len(p) + 1 for p, _ in parts)])[:-1]
        piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
        self.part = np.searchsorted(firsts, starts, side="right") - 1
        own = starts - firsts[self.part] < np.array([o for _, o in parts])[self.part]
        offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw[word]))])
        coded = words.dictionary_encode()
        self.dictionary, self.code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        #: starts[k]: places where a sequence of k + 1 words starts
        self.starts, places = [], np.flatnonzero(own)
        for k in range(LONGEST):
            places = places[places + k < len(piece)]
            places = places[piece[places + k] == piece[places]]
            self.starts.append(places)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def sequence_hashes(words: Words, langs: list[bytes]) -> list[np.ndarray]:
    """Hashes of the sequences that start at ``words.starts[k]``, by words and language."""
    of_word = np.fromiter((xxhash.xxh64_intdigest(w) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    names = {lang: xxhash.xxh64_intdigest(lang, 1) for lang in set(langs)}
    of_lang = np.array([names[lang] for lang in langs], np.uint64)
    token = _mix(of_word[words.code] ^ of_lang[words.part]) if len(words.code) else np.empty(0, np.uint64)
    out, before = [], np.zeros(len(token), np.uint64)
    for k, places in enumerate(words.starts):
        now = np.zeros(len(token), np.uint64)
        now[places] = _mix(before[places] * np.uint64(0x100000001B3) + token[places + k] + np.uint64(k))
        out.append(now[places] >> np.uint64(64 - HASH_BITS))
        before = now
    return out


def _chunks(parts: Iterator[pa.RecordBatch], by: Callable[[dict], int]) -> Iterator[list[tuple[dict, bytes, int]]]:
    """Lists of (row, text part, its own bytes) of about ``CHUNK`` bytes, rows of one group each."""
    held: dict[int, list] = {}
    size: dict[int, int] = {}
    for part in parts:
        others = part.drop_columns(["text"]).to_pylist()
        for row, text in zip(others, part.column("text").cast(pa.binary())):
            group = by(row)
            for piece, own in segments(text.as_py() or b""):
                held.setdefault(group, []).append((row, piece, own))
                size[group] = size.get(group, 0) + len(piece)
                if size[group] >= CHUNK:
                    yield held.pop(group)
                    size[group] = 0
    yield from held.values()


def local_supports(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, shard, support): least times the shard's share of the language's bytes, rounded up, in whole numbers."""
    sizes = docs.groupBy("lang", "shard").agg((F.sum(F.octet_length("text")) + F.count("*")).alias("size"))
    total = sizes.groupBy(F.col("lang").alias("of")).agg(F.sum("size").alias("total"))
    support = F.expr(f"cast((cast(size as decimal(38,0)) * {least} + total - 1) div total as int)")
    return sizes.join(total, F.col("lang") == F.col("of")).select("lang", "shard", support.alias("support"))


def local_counts(docs: DataFrame, ranges: int) -> DataFrame:
    """(shard, range, support, hashes, counts): what each chunk counted, cut by hash ranges; counts stop at 255."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(parts, lambda row: row["shard"]):
            words = Words([(piece, own) for _, piece, own in chunk])
            hashes = sequence_hashes(words, [row["lang"].encode() for row, _, _ in chunk])
            support = np.array([row["support"] for row, _, _ in chunk])[words.part] if len(words.part) else np.empty(0, int)
            for wanted in np.unique(support).tolist():
                here = [h[support[at] == wanted] for h, at in zip(hashes, words.starts)]
                found, n = np.unique(np.concatenate(here), return_counts=True)
                edges = np.searchsorted(found, [(r << HASH_BITS) // ranges for r in range(ranges + 1)])
                code = found.view(np.uint8).reshape(-1, 8)[:, : HASH_BITS // 8]
                n = np.minimum(n, 255).astype(np.uint8)
                some = [r for r in range(ranges) if edges[r] < edges[r + 1]]
                for at in range(0, len(some), 64):
                    cuts = [slice(edges[r], edges[r + 1]) for r in some[at : at + 64]]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "shard": [chunk[0][0]["shard"]] * len(cuts), "range": some[at : at + 64], "support": [wanted] * len(cuts),
                            "hashes": [code[c].tobytes() for c in cuts], "counts": [n[c].tobytes() for c in cuts],
                        },
                        pa.schema([("shard", pa.int32()), ("range", pa.int32()), ("support", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())]),
                    )

    return docs.select("shard", "support", "lang", "text").mapInArrow(count, "shard int, range int, support int, hashes binary, counts binary")


def frequent_bits(counts: DataFrame, tasks: int) -> DataFrame:
    """(bit_row, bits): the bitmap rows of the sequences with local support in some shard; ``tasks`` follow the text, so each stays small."""

    def mine(group: pa.Table) -> pa.Table:
        bits = []
        for wanted in pc.unique(group.column("support")).to_pylist():
            some = group.filter(pc.equal(group.column("support"), wanted))
            code = np.frombuffer(b"".join(some.column("hashes").to_pylist()), np.uint8).reshape(-1, HASH_BITS // 8)
            hashes = np.zeros((len(code), 8), np.uint8)
            hashes[:, : HASH_BITS // 8] = code
            hashes = hashes.view(np.uint64).ravel()
            n = np.frombuffer(b"".join(some.column("counts").to_pylist()), np.uint8)
            by = hashes.argsort(kind="stable")
            hashes = hashes[by]
            first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
            frequent = np.add.reduceat(n[by], first, dtype=np.int64) >= wanted
            bits.append(np.unique(hashes[first[frequent]] >> np.uint64(HASH_BITS - MAP_BITS)).astype(np.int64))
        bit = np.unique(np.concatenate(bits))
        rows = np.unique(bit >> ROW_BITS)
        marks = np.zeros((len(rows), 1 << ROW_BITS), np.uint8)
        marks[np.searchsorted(rows, bit >> ROW_BITS), bit & ((1 << ROW_BITS) - 1)] = 1
        return pa.table({"bit_row": pa.array(rows), "bits": pa.array([m.tobytes() for m in np.packbits(marks, axis=1, bitorder="little")], pa.binary())})

    mined = counts.repartition(tasks, "shard", "range").groupBy("shard", "range").applyInArrow(mine, "bit_row long, bits binary")
    return mined.groupBy("bit_row").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap(rows: DataFrame) -> np.ndarray:
    """The bitmap as bytes; its size is fixed (16 MB), whatever the corpus is."""
    out = np.zeros((1 << MAP_BITS) // 8, np.uint8)
    width = (1 << ROW_BITS) // 8
    for r in rows.toLocalIterator():
        out[r.bit_row * width : (r.bit_row + 1) * width] = np.frombuffer(r.bits, np.uint8)[:width]
    return out


def marked_counts(docs: DataFrame, marks: np.ndarray) -> DataFrame:
    """(lang, k, phrase, n): per chunk the sequences of k words that the bitmap names; k = 0 counts all words."""
    shared = docs.sparkSession.sparkContext.broadcast(marks.tobytes())

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for chunk in _chunks(parts, lambda row: 0):
            words = Words([(piece, own) for _, piece, own in chunk])
            names = sorted({row["lang"] for row, _, _ in chunk})
            number = {name: i for i, name in enumerate(names)}
            lang = np.array([number[row["lang"]] for row, _, _ in chunk])[words.part] if len(words.part) else np.empty(0, np.int64)
            # numbers of sequences by their words, exact: a sequence is the number of its front and its last word
            token = lang * len(words.dictionary) + words.code
            if len(names) * len(words.dictionary) >= 1 << 31:
                token = np.unique(token, return_inverse=True)[1]
            hashes = sequence_hashes(words, [row["lang"].encode() for row, _, _ in chunk])
            langs = pa.array(names)
            if len(words.starts[0]):
                n = np.bincount(lang[words.starts[0]], minlength=len(names))
                yield _rows(langs, 0, pa.array([""] * len(names)), n)
            text = words.dictionary.cast(pa.string())
            front, alive = token, np.ones(len(token), bool)
            for k, (places, h) in enumerate(zip(words.starts, hashes)):
                bit = (h >> np.uint64(HASH_BITS - MAP_BITS)).astype(np.int64)
                places = places[(bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1) & alive[places]]
                if not len(places):
                    break
                # the front of a frequent sequence is frequent, too
                key = front[places] if not k else front[places] << 32 | token[places + k]
                _, first, inverse, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                front, alive = np.zeros(len(token), np.int64), np.zeros(len(token), bool)
                front[places], alive[places] = inverse, True
                at = places[first]
                said = [text.take(pa.array(words.code[at + i])) for i in range(k + 1)]
                phrase = pc.binary_join_element_wise(*said, " ") if k else said[0]
                yield _rows(langs.take(pa.array(lang[at])), k + 1, phrase, n)

    return docs.select("lang", "text").mapInArrow(count, "lang string, k int, phrase string, n long")


def _rows(lang: pa.Array, k: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(n), k, np.int32)), phrase, pa.array(n.astype(np.int64))], ["lang", "k", "phrase", "n"])


def frequent_phrases(docs: DataFrame, work: Work, least: int = LEAST, shards: int = SHARDS) -> DataFrame:
    """(lang, k, phrase, n): all phrases of 1 to 4 words with at least ``least`` occurrences in a language, and its words as k = 0.

    ``docs``: doc_id, lang, text. Words are what is left between spaces and tabs after A-Z are lowered and texts are cut at
    ``.,;:!?`` and line ends; a null text is empty, a null language is ``und``.
    """
    rows = docs.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"),
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    supports = work.settle(local_supports(rows, least), "supports")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-size // 2 // shards // RANGE))
    marks = bitmap(work.settle(frequent_bits(local_counts(rows.join(supports, ["lang", "shard"]), ranges), shards * ranges), "bitmap"))
    counted = marked_counts(rows, marks).groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
    return work.settle(counted.filter(f"k = 0 OR n >= {least}"), "frequent")


def _slice(start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice("words", start, length), " ")


def collocations(docs: DataFrame, work: Work, least: int = LEAST, top: int = TOP, shards: int = SHARDS, share: int = 80) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to 4 words by score.

    a counts the phrase, l and r the two parts of its lowest-scoring cut, n all words of the language; the score is
    2,000,000 a / (l + r), rounded down, in decimals. A phrase inside a longer one with at least ``share`` percent of its
    occurrences is dropped. Order: score and a falling, then the phrase by its bytes. A table without text gives no rows.
    """
    counts = frequent_phrases(docs, work, least, shards)
    known = counts.filter("k > 0").select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("n").alias("times"))
    phrases = counts.filter("k > 1").withColumnRenamed("n", "a").withColumn("words", F.split("phrase", " "))
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "cut", _slice(1, F.col("cut")).alias("first"), _slice(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    # each join is written, so that a frequent word is a skewed join that the engine can split
    left = work.settle(cuts.join(known, (F.col("lang") == F.col("of")) & (F.col("first") == F.col("part"))).withColumnRenamed("times", "l").drop("of", "part", "first"), "left")
    both = left.join(known, (F.col("lang") == F.col("of")) & (F.col("rest") == F.col("part"))).withColumnRenamed("times", "r")
    both = work.settle(both.select("lang", "phrase", "a", "cut", "l", "r"), "both")
    score = F.expr("cast((cast(2000000 as decimal(8,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)")
    scored = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    longer = phrases.filter("k > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    inside = longer.select(F.col("lang").alias("of"), _slice(F.col("at"), F.col("size")).alias("part"), "a").groupBy("of", "part").agg(F.max("a").alias("outer"))
    covered = (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("part")) & (F.col("outer") * 100 >= F.col("a") * share)
    left_over = work.settle(scored.join(inside, covered, "left_anti").select("lang", "phrase", "a", "best.*"), "scored")
    order = (F.col("score").desc(), F.col("a").desc(), "phrase")
    salted = left_over.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    words = counts.filter("k = 0").select("lang", "n")
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
