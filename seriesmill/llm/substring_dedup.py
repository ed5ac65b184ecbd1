"""Removal of repeated byte strings: hash-compared suffix sort over the places where repeats can begin.

A repeat is a string of ``WIDTH`` bytes that starts in two places. Every such string is led by its
anchor, the gram of ``GRAM`` bytes in it with the smallest hash (the first of equals); equal strings
have equal anchors at equal offsets. Neighbouring strings share their anchor, so a text has one *block* (all
strings of one anchor, overlapping) about every 70 bytes. Blocks whose gram occurs once in the
corpus hold no repeat. Blocks that occur as a whole more than once are repeats as a whole. What is left,
different blocks around one gram, goes to a suffix sort: the strings of a group are merge-sorted
by comparing suffixes through prefix polynomial hashes, binary search on the length of the common
extension, and neighbours that agree over the full width are verified byte by byte.

A gram shared by very many different blocks is not sorted in one task: its strings are counted by
their digests instead, as sums that combine before they shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.simhash import whole_groups
from seriesmill.llm.work import Work

WIDTH, GRAM = 200, 64
#: Different blocks around one gram that are sorted in one task.
GROUP_BLOCKS = 2_048
#: Bytes of text, and strings, that are worked on at once.
CHUNK, STRINGS = 1 << 20, 1 << 18
_BASE = 0x2545F4914F6CDD1D
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def prefix_hashes(raw: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial over the bytes, modulo 2^64."""
    up, _ = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:], dtype=np.uint64)
    return sums


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """Smallest or largest (``best``) of each ``width`` neighbours, from running bests of blocks forwards and backwards."""
    n = len(values) - width + 1
    fill = np.uint64(0) if best is np.maximum else np.uint64(2**64 - 1)
    grid = np.concatenate([values, np.full(-len(values) % width, fill)]).reshape(-1, width)
    ahead = best.accumulate(grid, axis=1).reshape(-1)
    back = best.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return best(back[:n], ahead[width - 1 : width - 1 + n])


def blocks(raw: np.ndarray, ends: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor, lo, hi, gram hash, block hash) of texts that end at ``ends`` in ``raw``; strings lo..hi have this anchor."""
    span = width - gram + 1
    n = len(raw) - width + 1
    if n < 1:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    sums = prefix_hashes(raw)
    _, down = _powers(len(raw) + 1)
    g = _mixed((sums[gram:] - sums[:-gram]) * down[: len(raw) - gram + 1])
    g = np.maximum(g, np.uint64(1))  # 0 stands for no string
    low = _sliding(g, span, np.minimum)
    # strings that reach over the end of a text
    starts = np.concatenate([[0], ends[:-1]])
    cross = np.zeros(n + 1, np.int32)
    first_bad = np.maximum(ends - width + 1, starts)
    inside = first_bad < n
    np.add.at(cross, first_bad[inside], 1)
    np.add.at(cross, np.minimum(ends[inside], n), -1)
    low[np.cumsum(cross[:n]) > 0] = 0
    # a gram leads some string when the largest of the smallest around it is its own hash
    most = _sliding(np.concatenate([np.zeros(span - 1, np.uint64), low, np.zeros(span - 1, np.uint64)]), span, np.maximum)
    anchor = np.flatnonzero(most[: len(g)] == g)
    # strings with the same smallest hash, in runs; the run that a gram leads in is the first one of its hash within reach
    change = np.flatnonzero(low[1:] != low[:-1]) + 1
    run_from, run_to = np.concatenate([[0], change]), np.concatenate([change, [n]]) - 1
    run = np.searchsorted(run_to, np.maximum(anchor - span + 1, 0))
    wrong = np.flatnonzero(low[run_from[run]] != g[anchor])
    while len(wrong):
        run[wrong] += 1
        wrong = wrong[low[run_from[run[wrong]]] != g[anchor[wrong]]]
    before = np.full(len(anchor), -1, np.int64)
    before[1:] = np.where(run[1:] == run[:-1], anchor[:-1], -1)  # the first of equal grams leads
    lo = np.maximum(np.maximum(run_from[run], anchor - span + 1), before + 1)
    hi = np.minimum(run_to[run], anchor)
    good = lo <= hi
    anchor, lo, hi = anchor[good], lo[good], hi[good]
    b = _mixed((sums[hi + width] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return anchor, lo, hi, g[anchor], b


def _batched(texts: list[bytes], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    at = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _raw(part: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode() for t in part.column("text").to_pylist()]


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def gram_counts(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """(h, n, mixed): grams that lead strings in more than one place; mixed when their blocks differ."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            raw = _raw(part)
            for a, z in _batched(raw):
                ends = np.cumsum([len(t) for t in raw[a:z]])
                _, _, _, h, b = blocks(np.frombuffer(b"".join(raw[a:z]), np.uint8), ends, width, gram)
                order = np.lexsort((b, h))
                h, b = h[order], b[order]
                first = np.ones(len(h), bool)
                first[1:] = (h[1:] != h[:-1]) | (b[1:] != b[:-1])
                at = np.flatnonzero(first)
                yield pa.RecordBatch.from_arrays([_signed(h[at]), _signed(b[at]), pa.array(np.diff(np.append(at, len(h))))], ["h", "b", "n"])

    counted = texts.select("text").mapInArrow(count, "h long, b long, n long")
    sums = counted.groupBy("h").agg(F.sum("n").alias("n"), F.min("b").alias("b0"), F.max("b").alias("b1"))
    return sums.filter("n > 1").select("h", (F.col("b0") != F.col("b1")).alias("mixed"))


def block_places(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """(h, b, t, size, lo, hi, lead) of every block of ``texts`` (t, size, text); lead is the anchor's offset in the block."""

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            raw, t, size = _raw(part), part.column("t").to_numpy(), part.column("size").to_numpy()
            for a, z in _batched(raw):
                ends = np.cumsum([len(x) for x in raw[a:z]])
                anchor, lo, hi, h, b = blocks(np.frombuffer(b"".join(raw[a:z]), np.uint8), ends, width, gram)
                doc = np.searchsorted(ends, lo, side="right")
                start = np.concatenate([[0], ends])[doc]
                cols = [_signed(h), _signed(b), pa.array(t[a:z][doc]), pa.array(size[a:z][doc]), pa.array((lo - start).astype(np.int32)), pa.array((hi - start).astype(np.int32)), pa.array((anchor - lo).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, ["h", "b", "t", "size", "lo", "hi", "lead"])

    return texts.select("text", "t", "size").mapInArrow(place, "h long, b long, t long, size long, lo int, hi int, lead int")


class _Suffixes:
    """Suffix comparisons in one byte string, by prefix hashes; ``width`` bytes are compared at most."""

    def __init__(self, raw: np.ndarray, width: int) -> None:
        self.raw, self.width, self.sums = raw, width, prefix_hashes(raw)
        self.down = _powers(len(raw) + 1)[1]

    def _same(self, x: np.ndarray, y: np.ndarray, n) -> np.ndarray:
        return (self.sums[x + n] - self.sums[x]) * self.down[x] == (self.sums[y + n] - self.sums[y]) * self.down[y]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at x and y, by binary search."""
        length = np.where(self._same(x, y, self.width), self.width, 0)
        open_ = np.flatnonzero(length == 0)
        step = 1 << (self.width.bit_length() - 1)
        reach = np.zeros(len(open_), np.int64)
        while step:
            fits = np.flatnonzero(reach + step < self.width)
            a, b = x[open_[fits]] + reach[fits], y[open_[fits]] + reach[fits]
            reach[fits[self._same(a, b, step)]] += step
            step >>= 1
        length[open_] = reach
        return length

    def below(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether the suffix at x comes before that at y, or equals it where that counts."""
        n = self.common(x, y)
        at = np.minimum(n, self.width - 1)
        return np.where(n == self.width, or_equal, self.raw[x + at] < self.raw[y + at])

    def sort(self, at: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """``at`` merge-sorted within its groups; an item's group begins at ``first`` and has ``size`` items.

        All pairs of runs merge at once: an item moves up by its rank in the other run, found by binary search.
        """
        at, run = at.copy(), 1
        place = np.arange(len(at)) - first
        while run < size.max(initial=0):
            mine = np.flatnonzero(size > run)
            own = place[mine] // run
            other = own ^ 1
            begin = first[mine] + other * run
            low, high = np.zeros(len(mine), np.int64), np.clip(size[mine] - other * run, 0, run)
            while True:
                todo = np.flatnonzero(low < high)
                if not len(todo):
                    break
                mid = (low[todo] + high[todo]) // 2
                before = self.below(at[begin[todo] + mid], at[mine[todo]], own[todo] % 2 == 1)
                low[todo] = np.where(before, mid + 1, low[todo])
                high[todo] = np.where(before, high[todo], mid)
            sorted_ = at.copy()
            sorted_[first[mine] + own // 2 * 2 * run + place[mine] % run + low] = at[mine]
            at, run = sorted_, run * 2
        return at

    def equal(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Agreement over the full width: by hash, then byte by byte."""
        out = self._same(x, y, self.width)
        for a in range(0, len(x), 1 << 14):
            some = a + np.flatnonzero(out[a : a + (1 << 14)])
            wide = np.arange(self.width)
            out[some] = (self.raw[x[some][:, None] + wide] == self.raw[y[some][:, None] + wide]).all(axis=1)
        return out


def repeated_strings(group: np.ndarray, lead: np.ndarray, parts: list[bytes], width: int) -> np.ndarray:
    """Which strings of the blocks ``parts`` occur in another block of their group, all blocks after each other.

    Strings are compared with those at the same offset from the anchor only: equal strings have it.
    """
    sizes = np.array([len(p) for p in parts])
    starts = np.cumsum(sizes) - sizes
    counts = sizes - width + 1
    flagged = np.zeros(counts.sum(), bool)
    block = np.repeat(np.arange(len(parts)), counts)
    inside = np.arange(len(block)) - np.repeat(np.cumsum(counts) - counts, counts)
    offset = inside - lead[block]
    order = np.lexsort((offset, group[block]))
    key_g, key_o = group[block[order]], offset[order]
    new = np.ones(len(order), bool)
    new[1:] = (key_g[1:] != key_g[:-1]) | (key_o[1:] != key_o[:-1])
    first_at = np.flatnonzero(new)
    size = np.diff(np.append(first_at, len(order)))
    number = np.cumsum(new) - 1
    several = size[number] > 1
    order, number = order[several], number[several]
    if not len(order):
        return flagged
    kept = np.ones(len(order), bool)
    kept[1:] = number[1:] != number[:-1]
    heads = np.flatnonzero(kept)
    count = np.diff(np.append(heads, len(order)))
    which = np.cumsum(kept) - 1
    at = starts[block[order]] + inside[order]
    suffixes = _Suffixes(np.frombuffer(b"".join(parts), np.uint8), width)
    ranked = suffixes.sort(at, heads[which], count[which])
    same = np.zeros(len(ranked), bool)
    pair = np.flatnonzero(which[1:] == which[:-1])
    same[pair] = suffixes.equal(ranked[pair], ranked[pair + 1])
    hit = same.copy()
    hit[1:] |= same[:-1]
    # back from places in the joined bytes to strings
    owner = np.searchsorted(starts, ranked[hit], side="right") - 1
    flagged[(np.cumsum(counts) - counts)[owner] + ranked[hit] - starts[owner]] = True
    return flagged


def _runs(flagged: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], flagged.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def sorted_repeats(pieces: DataFrame, width: int) -> DataFrame:
    """(t, size, a, z): repeated byte runs of blocks of their own (n = 1) of ``pieces`` (h, t, size, lo, lead, n, bytes)."""

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(parts, ("h",)):
            h = table.column("h").to_numpy()
            ends = np.flatnonzero(np.append(h[1:] != h[:-1], True)) + 1
            at = 0
            while at < len(h):
                # whole groups of about STRINGS strings
                stop = ends[np.searchsorted(ends, min(len(h), at + max(1, STRINGS // 70)))]
                part = table.slice(at, stop - at)
                at = stop
                raw, n = part.column("bytes").to_pylist(), part.column("n").to_numpy()
                flagged = repeated_strings(part.column("h").to_numpy(), part.column("lead").to_numpy(), raw, width)
                counts = np.array([len(p) for p in raw]) - width + 1
                begin = np.cumsum(counts) - counts
                owner = np.repeat(np.arange(len(raw)), counts)
                flagged &= n[owner] == 1
                # runs end with their block: a block has its own place in the text
                edge = np.zeros(len(flagged) + 1, bool)
                edge[begin] = True
                a = np.flatnonzero(flagged & (edge[:-1] | ~np.concatenate([[False], flagged[:-1]])))
                z = np.flatnonzero(flagged & (np.concatenate([edge[1:-1], [True]]) | ~np.concatenate([flagged[1:], [False]])))
                own = owner[a]
                lo = part.column("lo").to_numpy()[own] - begin[own]
                yield pa.RecordBatch.from_arrays(
                    [part.column("t").combine_chunks().take(pa.array(own)), part.column("size").combine_chunks().take(pa.array(own)),
                     pa.array((a + lo).astype(np.int32)), pa.array((z + lo + width).astype(np.int32))],
                    ["t", "size", "a", "z"],
                )

    rows = pieces.select("h", "t", "size", "lo", "lead", "n", "bytes").repartition("h").sortWithinPartitions("h")
    return rows.mapInArrow(search, "t long, size long, a int, z int")


def counted_repeats(pieces: DataFrame, work: Work, width: int) -> DataFrame:
    """The same for the blocks of very frequent grams: each string is counted by its digest, in sums that combine."""

    def digests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                raw = row["bytes"]
                number = len(raw) - width + 1
                found = [hashlib.blake2b(raw[i : i + width], digest_size=16).digest() for i in range(number)]
                cols = [pa.array(found, pa.binary())] + [pa.array(np.full(number, row[k])) for k in ("t", "size", "n")]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(np.arange(number, dtype=np.int32) + row["lo"])], ["digest", "t", "size", "n", "at"])

    strings = pieces.select("t", "size", "lo", "n", "bytes").mapInArrow(digests, "digest binary, t long, size long, n long, at int")
    strings = work.settle(strings, "strings")
    again = work.settle(strings.groupBy("digest").agg(F.sum("n").alias("times")).filter("times > 1").select("digest"), "repeated-strings")
    return strings.filter("n = 1").join(again, "digest").select("t", "size", F.col("at").alias("a"), (F.col("at") + width).cast("int").alias("z"))


def cut_out(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """(removed bytes, maximal runs, what is left) after removing ``spans``."""
    kept, removed, runs, upto = [], 0, 0, 0
    last = -1
    for a, z in sorted(spans):
        if a > last:
            runs += 1
            kept.append(raw[upto:a])
            removed += z - a
            upto = last = z
        elif z > last:
            removed += z - last
            upto = last = z
    kept.append(raw[upto:])
    return removed, runs, b"".join(kept)


def repeated_spans(docs: DataFrame, work: Work, width: int = WIDTH, gram: int = GRAM, group_blocks: int = GROUP_BLOCKS) -> DataFrame:
    """(t, size, spans) per different text with repeats: byte runs covered by strings of ``width`` that start elsewhere too.

    ``t`` and ``size`` identify a text (its hash and its bytes); copies have the same repeats.
    """
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.select("doc_id", "text", text_key(F.col("text")).alias("t"), F.octet_length("text").cast("long").alias("size"))
    long_enough = texts.filter(F.col("size") >= width)
    grams = work.settle(gram_counts(long_enough, width, gram), "grams")
    work.release()
    places = work.settle(block_places(long_enough, width, gram).join(grams, "h"), "places")
    work.release()
    per_block = places.groupBy("h", "b", "mixed").agg(
        F.count("*").alias("n"), F.min("t").alias("t"), F.min_by("size", "t").alias("size"), F.min_by("lo", "t").alias("lo"),
        F.min(F.col("hi") - F.col("lo")).alias("more"), F.min("lead").alias("lead"),
    ).withColumn("hi", (F.col("lo") + F.col("more")).cast("int"))
    per_block = work.settle(per_block, "blocks")
    whole = places.join(per_block.filter("n > 1").select("h", "b"), ["h", "b"]).select("t", "size", F.col("lo").alias("a"), (F.col("hi") + width).cast("int").alias("z"))

    # the bytes of one of each of the different blocks around a gram
    owners = texts.select("doc_id", "t", "size").groupBy("t", "size").agg(F.min("doc_id").alias("owner"))
    wanted = (
        per_block.filter("mixed").groupBy("t", "size")
        .agg(F.collect_list(F.struct("h", "n", "lo", "hi", "lead")).alias("wanted"))
        .join(owners, ["t", "size"])
    )
    wanted = work.settle(wanted, "wanted")

    def fetch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for raw, t, size, items in zip(_raw(part), *(part.column(c).to_pylist() for c in ("t", "size", "wanted"))):
                rows += [(w["h"], t, size, w["lo"], w["lead"], w["n"], raw[w["lo"] : w["hi"] + width]) for w in items]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            cols = zip(*rows) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["h", "t", "size", "lo", "lead", "n", "bytes"])

    mine = texts.alias("x").join(
        wanted.alias("w"), (F.col("x.t") == F.col("w.t")) & (F.col("x.size") == F.col("w.size")) & F.col("x.doc_id").eqNullSafe(F.col("w.owner"))
    )
    mine = mine.select("x.text", "x.t", "x.size", "wanted")
    pieces = work.settle(mine.mapInArrow(fetch, "h long, t long, size long, lo int, lead int, n long, bytes binary"), "pieces")
    work.release()
    crowded = work.settle(pieces.groupBy("h").agg(F.count("*").alias("different")).filter(F.col("different") > group_blocks).select("h"), "crowded")
    found = sorted_repeats(pieces.join(crowded, "h", "left_anti"), width)
    if not crowded.isEmpty():
        found = found.unionByName(counted_repeats(pieces.join(crowded, "h", "left_semi"), work, width))
    spans = work.settle(whole.unionByName(found).distinct(), "spans")
    work.drop(places, pieces, wanted)
    return work.settle(spans.groupBy("t", "size").agg(F.collect_list(F.struct("a", "z")).alias("spans")), "text-spans")


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def remove_repeats(
    docs: DataFrame, work: Work, width: int = WIDTH, gram: int = GRAM, group_blocks: int = GROUP_BLOCKS, with_bytes: bool = True
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes, on demand), kept_sha256.

    Every byte covered by a string of ``width`` bytes that also starts anywhere else, in the same text or
    another one, is removed; overlaps count and strings never cross texts. A null text is empty, texts
    shorter than ``width`` keep everything, rows that repeat a text of at least ``width`` lose it whole. An empty table gives no rows.
    """
    spans = repeated_spans(docs, work, width, gram, group_blocks)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).select("doc_id", "text", text_key(F.col("text")).alias("t"), F.octet_length("text").cast("long").alias("size"))

    def remove(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for raw, items in zip(_raw(part), part.column("spans").to_pylist()):
                removed, runs, kept = cut_out(raw, [(s["a"], s["z"]) for s in items or ()])
                out.append((len(raw), removed, runs, kept if with_bytes else None, hashlib.sha256(kept).hexdigest()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            cols = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = rows.join(spans, ["t", "size"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
