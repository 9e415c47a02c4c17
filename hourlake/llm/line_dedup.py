"""Operator 8: line deduplication by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity over the whole corpus; two lines whose
Jaccard index reaches the threshold share a word among the rarest few of each (prefix filter). Lines that
share one are compared by length, by the position of the word and by a 64-bit parity map of the set, whose
differing bits bound the symmetric difference; what is left is verified on the full sets. A line goes
if an earlier line, in the order of (doc_id, hash of the text, line number), equals or matches it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlake.llm.common import alone, fresh, mark, result, stored, tidy
from hourlake.llm.membership import SPARSE, bit_filter, merged, passing, sparse
from hourlake.llm.words import BUFFER, buffer_words, distinct, mixed, word_hashes

#: Jaccard index in hundredths from which lines match.
THRESHOLD = 80
#: Bits of a word's hash that sets hold, counters of the rarity sketch, and words from which a line has a second parity map.
HASH_BITS, COUNTERS, WIDE = 48, 1 << 23, 64
#: Lines of a prefix word from which it is heavy and its lines are dealt over several groups. With more than HEAVY << 20 rows
#: of prefix words in all it grows, so that there are never more than HEAVY_WORDS such words.
HEAVY, HEAVY_WORDS = 4096, 1 << 20
#: Earlier candidates of a line that the first round verifies for each shared word; a line with more that all fail gets every one in a second.
FIRST = 2
#: Lines that are taken into arrays at once; rows of prefix words that a task packs at once, and that a bucket holds on average at most.
LINES, PACKED, BUCKET_ROWS = 60_000, 250_000, 500_000
#: Lines that a task remembers, to tell which it has met before.
SEEN = 150_000
#: Rows of a group from which its pairs are compared in strips of the earliest lines, dropping lines that have FIRST candidates.
STRIPS, STRIP = 256, 32
#: Pairs of smaller groups that are compared at once.
PAIRS = 1 << 15

_LOW = np.uint64((1 << HASH_BITS) - 1)
#: Stands for a null id, if no row has this one.
_NULL_ID = -(1 << 63)


def line_sets(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For lines of a buffer, at most 65,536: all sorted set words in a row, each line's number of words, key, parity bits, and those of one half of the words.

    With the second map, lines of more than WIDE words are compared on 128 bits; 64 would be too full to tell them apart.
    """
    if len(data) <= BUFFER // 2 or b"\n" in data:
        hashes, starts = buffer_words(data)
        breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    else:  # one very long line
        hashes, breaks = word_hashes(data), np.empty(0, np.int64)
        starts = np.zeros(len(hashes), np.int64)
    ends = np.append(np.searchsorted(starts, breaks), len(starts))
    owner = np.repeat(np.arange(len(ends), dtype=np.uint64), np.diff(ends, prepend=0))
    both = distinct(owner << np.uint64(HASH_BITS) | (hashes & _LOW))
    words, owner = both & _LOW, (both >> np.uint64(HASH_BITS)).astype(np.int64)
    sizes = np.bincount(owner, minlength=len(breaks) + 1)
    keys, bits, half = (np.zeros(len(sizes), np.uint64) for _ in range(3))
    some = np.flatnonzero(sizes)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        keys[some] = mixed(np.add.reduceat(mixed(words), starts) + sizes[some].astype(np.uint64))
        slots = np.uint64(1) << (words >> np.uint64(HASH_BITS - 6))
        bits[some] = np.bitwise_xor.reduceat(slots, starts)
        half[some] = np.bitwise_xor.reduceat(slots * (words >> np.uint64(HASH_BITS - 7) & np.uint64(1)), starts)
        half[sizes <= WIDE] = 0
    return words, sizes, keys, bits, half


def line_buffers(texts: Iterator[tuple[int, bytes]]) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Texts cut into buffers of whole lines, with what lines they hold: (text, first line, lines). A line too long for a buffer has one of its own."""
    held, parts, size, count = [], [], 0, 0
    for k, text in texts:
        n = text.count(b"\n") + 1
        small = len(text) < BUFFER // 2 and n < LINES
        pieces = [(0, n, text)] if small else [(i, 1, line) for i, line in enumerate(text.split(b"\n"))]
        for first, lines, piece in pieces:
            if held and (size + len(piece) + 1 > BUFFER // 2 or count + lines > LINES):
                yield b"\n".join(held), parts
                held, parts, size, count = [], [], 0, 0
            held.append(piece)
            parts.append((k, first, lines))
            size += len(piece) + 1
            count += lines
    if held:
        yield b"\n".join(held), parts


def pack(words: np.ndarray) -> np.ndarray:
    """Bytes of hashes, HASH_BITS each."""
    return np.ascontiguousarray(words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : HASH_BITS // 8]).reshape(-1)


def unpack(data: bytes | memoryview) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, HASH_BITS // 8)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, : HASH_BITS // 8] = raw
    return out.reshape(-1).view("<u8")


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def numbered(docs: DataFrame) -> tuple[DataFrame, Column | None]:
    """docs (doc_id, text) with a long `doc` that is unique to, and ordered as, (doc_id, hash of the text); and the expression of it, if one of doc_id is enough.

    Whole numbers stand for themselves, if no id has two texts. Other ids get their rank, which is joined to the texts; `dh` is the hash then.
    """
    if docs.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long"):
        own = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID))
        several = stored(docs.groupBy(own.alias("doc")).agg(F.count("*").alias("n")).where("n > 1").select("doc"), "line-several")
        texts = docs.join(several, own == F.col("doc")).groupBy("doc").agg(F.min(_text_hash(F.col("text"))).alias("least"), F.max(_text_hash(F.col("text"))).alias("most"))
        if several.isEmpty() or texts.where("least <> most").isEmpty():
            return docs.withColumn("doc", own), own
    docs = docs.withColumn("dh", _text_hash(F.col("text")))
    ranks = docs.select("doc_id", "dh").distinct().orderBy(F.col("doc_id").asc_nulls_first(), "dh")
    ranks = stored(ranks.withColumn("doc", F.monotonically_increasing_id()), "line-ranks")
    return docs.join(ranks, docs["doc_id"].eqNullSafe(ranks["doc_id"]) & (docs["dh"] == ranks["dh"])).select(docs["doc_id"], docs["dh"], "text", "doc"), None


LINE = "doc long, line int, key long, bits long, half long, n int, again boolean, words binary"
_LINE_COLUMNS = [f.split()[0] for f in LINE.split(", ")]


def corpus_lines(docs: DataFrame) -> DataFrame:
    """A stored row of LINE for each line with words of docs (doc, text). again: the task has met an equal, earlier line before; words is empty then."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            docs = batch.column(0).to_numpy()
            texts = ((k, (t.as_py() or "").encode("utf-8").lower()) for k, t in enumerate(batch.column(1)))
            for data, parts in line_buffers(texts):
                words, sizes, keys, bits, half = line_sets(data)
                of = docs[np.repeat([k for k, _, _ in parts], [n for _, _, n in parts])]
                numbers = np.concatenate([np.arange(first, first + n) for _, first, n in parts])
                keep = np.flatnonzero(sizes)
                new = np.ones(len(keep), bool)
                names = np.stack([keys[keep], bits[keep]], 1).view("V16")[:, 0].tolist()
                for at, (name, doc, number) in enumerate(zip(names, of[keep].tolist(), numbers[keep].tolist(), strict=True)):
                    place = doc << 32 | number
                    if (before := seen.get(name)) is None or place < before:
                        seen[name] = place
                    else:
                        new[at] = place == before
                if len(seen) > SEEN:
                    seen.clear()
                some = np.zeros(len(sizes), bool)
                some[keep] = new
                ends = np.cumsum(np.where(new, sizes[keep], 0)) * (HASH_BITS // 8)
                offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes())
                binary = pa.Array.from_buffers(pa.binary(), len(keep), [None, offsets, pa.py_buffer(pack(words[np.repeat(some, sizes)]).tobytes())])
                columns = [pa.array(of[keep]), pa.array(numbers[keep].astype(np.int32)), *(pa.array(c[keep].view(np.int64)) for c in (keys, bits, half)), pa.array(sizes[keep].astype(np.int32)), pa.array(~new), binary]
                yield pa.RecordBatch.from_arrays(columns, _LINE_COLUMNS)

    return stored(docs.select("doc", "text").mapInArrow(alone(work), LINE), "line-sets")


def joinable(lines: DataFrame) -> DataFrame:
    """The lines that take part in the join: with so many words that not only equal lines match."""
    return lines.where("n > 3 and not again")


def rarity(lines: DataFrame) -> np.ndarray:
    """For each counter, how often its words occur in lines: at least a word's own count, over the whole corpus."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            column = batch.column(0)
            for at in range(0, len(column), 20_000):
                words = unpack(b"".join(column.slice(at, 20_000).to_pylist()))
                place, n = np.unique((words & np.uint64(COUNTERS - 1)).astype(np.int64), return_counts=True)
                counts[place] += n.astype(np.uint32)
        yield sparse(counts)

    return merged(joinable(lines).select("words").mapInArrow(alone(work), SPARSE), COUNTERS, "uint32", True)


def prefix_length(sizes: np.ndarray) -> np.ndarray:
    """How many of a line's rarest words another line must share one of to match it."""
    return sizes * (100 - THRESHOLD) // 100 + 1


def sorted_order(*keys: np.ndarray) -> np.ndarray:
    """The stable order of arrays of whole numbers that are not negative, the first before all others: as np.lexsort, by one plain sort where all bits fit in 64."""
    n = len(keys[0])
    widths = [int(k.max()).bit_length() if n else 0 for k in keys]
    low = n.bit_length()
    if sum(widths) + low > 64:
        return np.lexsort(keys[::-1])
    packed = np.zeros(n, np.uint64)
    for key, width in zip(keys, widths, strict=True):
        packed = packed << np.uint64(width) | key.astype(np.uint64)
    packed = packed << np.uint64(low) | np.arange(n, dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << low) - 1)).astype(np.int64)


def prefixes(batch: pa.RecordBatch, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, rows, places) of the rarest words of each row of a batch of LINE, but for words that occur in one line alone."""
    sizes = batch.column("n").to_numpy().astype(np.int64)
    words = unpack(b"".join(batch.column("words").to_pylist()))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    count = often[(words & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.int64)
    order = sorted_order(owner, count)  # by line, then by count; words of a line are sorted by hash already
    words, count = words[order], count[order]
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keep = np.flatnonzero((place < prefix_length(sizes)[owner]) & (count > 1))
    return words[keep], owner[keep], place[keep]


def with_frequent(batch: pa.RecordBatch, often: np.ndarray, least: int) -> pa.RecordBatch:
    """The rows of a batch of LINE that may have a word with a counter above `least` among their rarest: those with fewer other words than the rarest are."""
    sizes = batch.column("n").to_numpy().astype(np.int64)
    words = unpack(b"".join(batch.column("words").to_pylist()))
    others = np.concatenate([[0], np.cumsum(often[(words & np.uint64(COUNTERS - 1)).astype(np.int64)] <= least)])
    ends = np.cumsum(sizes)
    return batch.filter(pa.array(others[ends] - others[ends - sizes] < prefix_length(sizes)))


def heavy_words(lines: DataFrame, counts: Broadcast, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted words, groups) of the words that more than `least` lines have among their rarest, counted exactly; such words' lines go to several groups.

    Only words whose counter is above `least` need counting: the others occur in fewer lines anyway.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.frombuffer(counts.value, np.uint32)
        for whole in batches:
            for at in range(0, whole.num_rows, 5000):
                words, _, _ = prefixes(with_frequent(whole.slice(at, 5000), often, least), often)
                words = words[often[(words & np.uint64(COUNTERS - 1)).astype(np.int64)] > least]
                words, n = np.unique(words, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

    with tidy(lines.sparkSession):
        found = joinable(lines).select("n", "words").mapInArrow(alone(work), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") > least)
        rows = sorted((r["word"], r["n"]) for r in found.collect())  # fewer than HEAVY_WORDS, as `least` is at least their share of all rows
    return np.array([w for w, _ in rows], np.uint64), np.array([-(-n // least) for _, n in rows], np.int64)


def needed(rows: DataFrame) -> Broadcast:
    """A bit filter of the lines (doc, line)."""
    return bit_filter(rows.select(F.xxhash64("doc", "line")))


_PLANES = (("part", "<u4"), ("doc", "<i8"), ("line", "<u4"), ("bits", "<u8"), ("half", "<u8"), ("n", "<u4"), ("place", "<u4"))
_WIDTH = sum(np.dtype(t).itemsize for _, t in _PLANES)
#: Lowest bits of a packed place: the row may be the earlier line of a pair; the later one; its word is heavy.
EARLIER, LATER, WEIGHTY = 1, 2, 4


def packed(columns: list[np.ndarray]) -> bytes:
    """Columns as planes of their bytes, so that bytes which are mostly zeros stand together."""
    return np.concatenate([np.ascontiguousarray(c.astype(t).view(np.uint8).reshape(len(c), -1).T).reshape(-1) for c, (_, t) in zip(columns, _PLANES, strict=True)]).tobytes()


def unpacked(blobs: list[bytes]) -> list[np.ndarray]:
    out: list[list[np.ndarray]] = [[] for _ in _PLANES]
    for blob in blobs:
        raw, n, at = np.frombuffer(blob, np.uint8), len(blob) // _WIDTH, 0
        for k, (_, kind) in enumerate(_PLANES):
            width = np.dtype(kind).itemsize
            out[k].append(np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).reshape(-1).view(kind))
            at += n * width
    return [np.concatenate(c) for c in out]


def prefix_rows(lines: DataFrame, counts: Broadcast, heavy: Broadcast, buckets: int, least: int, asking: Broadcast | None = None, words_asked: Broadcast | None = None) -> DataFrame:
    """(bucket, rows): the rarest words of each line, in buckets of a hash, many to a row.

    A row of a word has the line's place, parity bits and number of words, and the place of the word. The lines of a heavy word
    are dealt over groups. In the first round each of these groups also gets about `least` of the word's lines, chosen by a hash, as possible earlier
    lines. In the second (with `asking`, a filter of lines, and `words_asked`, one of the names of their groups) the groups part all of them
    and the lines that ask go to each.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.frombuffer(counts.value, np.uint32)
        heavy_words, heavy_groups = heavy.value
        held: list[list[np.ndarray]] = []

        def dealt(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            h = mixed(words)
            return ((h & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int32), h >> np.uint64(32)

        def flush() -> Iterator[pa.RecordBatch]:
            bucket, *columns = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            columns = [c[order] for c in columns]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
            for at in range(0, len(cuts), 4096):
                ends = [*cuts[at + 1 : at + 4097], len(bucket)][: len(cuts[at : at + 4096])]
                spans = list(zip(cuts[at : at + 4096], ends, strict=True))
                blobs = [packed([c[a:z] for c in columns]) for a, z in spans]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[[a for a, _ in spans]]), pa.array(blobs, pa.binary())], ["bucket", "rows"])
            held.clear()

        for whole in batches:
            for at in range(0, whole.num_rows, 5000):
                batch = whole.slice(at, 5000)
                words, owner, place = prefixes(batch, often)
                asks = np.ones(batch.num_rows, bool)
                if asking is not None:
                    asks = passing(asking, batch.column("h")).to_numpy(zero_copy_only=False)
                    of_bucket, part = dealt(words)
                    keep = passing(words_asked, pa.array(group_name(of_bucket, part))).to_numpy(zero_copy_only=False) | np.isin(words, heavy_words)
                    words, owner, place = words[keep], owner[keep], place[keep]
                doc, line, bits, half, key, n = (batch.column(c).to_numpy()[owner] for c in ("doc", "line", "bits", "half", "key", "n"))
                role = np.where(asks[owner], EARLIER | LATER, EARLIER)
                group = np.zeros(len(words), np.int64)
                if len(heavy_words) and len(words):
                    at_word = np.minimum(np.searchsorted(heavy_words, words), len(heavy_words) - 1)
                    weighty = np.flatnonzero(heavy_words[at_word] == words)
                    groups = heavy_groups[at_word[weighty]]
                    chance = mixed(key.view(np.uint64)[weighty])
                    group[weighty] = (chance % groups.astype(np.uint64)).astype(np.int64)
                    role[weighty] |= WEIGHTY
                    # To the other groups: in the first round as an earlier line, for one line of so many; then as a later line, if it asks.
                    out = asks[owner[weighty]] if asking is not None else (chance >> np.uint64(32)) % groups.astype(np.uint64) == 0
                    more, times = weighty[out], groups[out] - 1
                    copy = np.repeat(more, times)
                    other = np.arange(len(copy)) - np.repeat(np.cumsum(times) - times, times)
                    other += other >= group[copy]
                    words, doc, line, bits, half, n, place = (np.concatenate([c, c[copy]]) for c in (words, doc, line, bits, half, n, place))
                    role = np.concatenate([role, np.full(len(copy), WEIGHTY | (LATER if asking is not None else EARLIER))])
                    group = np.concatenate([group, other])
                held.append([*dealt(words ^ group.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), doc, line, bits, half, n, place << 3 | role])
                if sum(len(h[0]) for h in held) > PACKED:
                    yield from flush()
        if held:
            yield from flush()

    names = ["doc", "line", "key", "bits", "half", "n", "words", F.xxhash64("doc", "line").alias("h")]
    return joinable(lines).select(names).mapInArrow(alone(work), "bucket int, rows binary")


class Rows:
    """Rows of prefix words sorted by group, then by the order of lines, with the filters that tell which pairs are candidates."""

    def __init__(self, part: np.ndarray, doc: np.ndarray, line: np.ndarray, bits: np.ndarray, half: np.ndarray, n: np.ndarray, place: np.ndarray):
        order = sorted_order(doc.view(np.uint64) - doc.min().view(np.uint64), line) if len(doc) else np.empty(0, np.int64)
        order = order[sorted_order(part[order])]
        part, doc, line = part[order], doc[order], line[order]
        new = np.ones(len(order), bool)  # rows of repeated documents are alike
        new[1:] = (part[1:] != part[:-1]) | (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])
        order = order[new]
        self.part, self.doc, self.line, self.bits = part[new], doc[new], line[new], bits[order]
        self.half = half[order]
        self.n, place = n[order].astype(np.int64), place[order].astype(np.int64)
        self.role, self.rest = place & 7, self.n - (place >> 3)
        self.starts = np.flatnonzero(np.diff(self.part.astype(np.int64), prepend=-1))
        self.sizes = np.diff(self.starts, append=len(self.part))

    def candidates(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which of the pairs (x later than y) can match: by length, role, position and parity bits."""
        a, b = self.n[x], self.n[y]
        ok = np.flatnonzero((100 * a >= THRESHOLD * b) & (100 * b >= THRESHOLD * a))
        x, y, total = x[ok], y[ok], a[ok] + b[ok]
        need = -(-THRESHOLD * total // (100 + THRESHOLD))
        some = np.flatnonzero((np.minimum(self.rest[x], self.rest[y]) >= need) & (self.role[x] & LATER > 0) & (self.role[y] & EARLIER > 0))
        ok, x, y, slack = ok[some], x[some], y[some], (total - 2 * need)[some]
        apart = self.bits[x] ^ self.bits[y]
        some = np.flatnonzero(np.bitwise_count(apart) <= slack)
        ok, x, y, apart, slack = ok[some], x[some], y[some], apart[some], slack[some]
        wide = np.flatnonzero((self.n[x] > WIDE) & (self.n[y] > WIDE))
        if not len(wide):
            return ok
        half = self.half[x[wide]] ^ self.half[y[wide]]
        far = wide[np.bitwise_count(half).astype(np.int64) + np.bitwise_count(apart[wide] ^ half) > slack[wide]]
        return np.delete(ok, far)

    def pairs(self, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(x, y) of the candidate pairs and which x may have others; with `first` not 0 only so many earliest y of each x."""
        xs, ys, more = [], [], np.zeros(len(self.part), bool)
        size = np.repeat(self.sizes, self.sizes)
        last = np.repeat(self.starts + self.sizes, self.sizes)
        left = np.flatnonzero((size > 1) & (size <= STRIPS) & (self.role & EARLIER > 0))
        later = last[left] - left - 1  # rows of the group behind each
        upto = np.cumsum(later)
        cuts = [0, *np.searchsorted(upto, np.arange(PAIRS, upto[-1], PAIRS)).tolist(), len(left)] if len(left) else []
        for a, z in pairwise(cuts):
            y, n = left[a:z], later[a:z]
            y, x = np.repeat(y, n), np.repeat(y + 1 - np.cumsum(n) + n, n) + np.arange(n.sum())
            ok = self.candidates(x, y)
            xs.append(x[ok])
            ys.append(y[ok])
        for k in np.flatnonzero(self.sizes > STRIPS).tolist():
            start, end = int(self.starts[k]), int(self.starts[k] + self.sizes[k])
            alive = np.arange(start + 1, end)
            alive = alive[self.role[alive] & LATER > 0]
            have = np.zeros(end - start, np.int64)
            for at in range(start, end, STRIP):
                alive = alive[alive > at]
                if not len(alive):
                    break
                strip = np.arange(at, min(at + STRIP, end))
                x, y = np.tile(alive, len(strip)), np.repeat(strip, len(alive))
                ok = np.flatnonzero(x > y)
                ok = ok[self.candidates(x[ok], y[ok])]
                xs.append(x[ok])
                ys.append(y[ok])
                if first:
                    have += np.bincount(x[ok] - start, minlength=end - start)
                    done = have[alive - start] >= first
                    more[alive[done & (alive > strip[-1] + 1)]] = True
                    alive = alive[~done]
        x, y = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (xs, ys))
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        if first and len(x):
            rank = np.arange(len(x)) - np.searchsorted(x, x)
            more[x[rank >= first]] = True
            x, y = x[rank < first], y[rank < first]
        return x, y, more


def group_name(bucket: int | np.ndarray, part: np.ndarray) -> np.ndarray:
    """A long that names a group of a bucket."""
    return mixed(np.uint64(0x9E3779B97F4A7C15) * (np.atleast_1d(bucket).astype(np.uint64) + np.uint64(1)) ^ part.astype(np.uint64)).view(np.int64)


PAIR = "doc long, line int, y_doc long, y_line int, more boolean"
_PAIR_COLUMNS = [f.split()[0] for f in PAIR.split(", ")]


def candidate_pairs(rows: DataFrame, first: int) -> DataFrame:
    """Pairs of a later line (doc, line) and an earlier one (y_doc, y_line) that pass the filters.

    For each word only the `first` earliest candidates of a later line are given; 0: all. A row with `more` and without y_line is for a later
    line that may have others, and has the word's group, or null for a heavy word, in y_doc.
    """
    rows = rows.repartition("bucket").sortWithinPartitions("bucket")

    def found(bucket: int, blobs: list[bytes]) -> pa.RecordBatch:
        table = Rows(*unpacked(blobs))
        x, y, more = table.pairs(first)
        if first:
            more |= (table.role & (LATER | WEIGHTY)) == LATER | WEIGHTY  # it has met only some lines of its word
        m = np.flatnonzero(more)
        both = np.unique(np.stack([table.doc[x], table.line[x].astype(np.int64), table.doc[y], table.line[y].astype(np.int64)], 1), axis=0)
        lacking = np.arange(len(both) + len(m)) >= len(both)
        columns = [
            pa.array(np.concatenate([both[:, 0], table.doc[m]])),
            pa.array(np.concatenate([both[:, 1], table.line[m]]).astype(np.int32)),
            pa.array(np.concatenate([both[:, 2], group_name(bucket, table.part[m])]), mask=np.concatenate([np.zeros(len(both), bool), table.role[m] & WEIGHTY > 0])),
            pa.array(np.concatenate([both[:, 3], np.zeros(len(m), np.int64)]).astype(np.int32), mask=lacking),
            pa.array(lacking),
        ]
        return pa.RecordBatch.from_arrays(columns, _PAIR_COLUMNS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if held and bucket != last:
                    yield found(last, held)
                    held = []
                last = bucket
                held.append(blob.as_buffer())
        if held:
            yield found(last, held)

    return rows.mapInArrow(alone(work), PAIR)


def verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The later lines (doc, line) of pairs whose full sets reach the threshold."""
    pairs = stored(pairs.select("doc", "line", "y_doc", "y_line"), "line-checked")
    wanted = needed(pairs.select("doc", "line").union(pairs.select("y_doc", "y_line")))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(passing(wanted, batch.column("h"))).select(["doc", "line", "words"])

    sets = joinable(lines).select("doc", "line", "words", F.xxhash64("doc", "line").alias("h")).mapInArrow(alone(some), "doc long, line int, words binary")
    sets = stored(sets, "line-wanted")  # few, and both sides of the pairs need them
    pairs = pairs.join(sets, ["doc", "line"])
    pairs = pairs.join(sets.select(F.col("doc").alias("y_doc"), F.col("line").alias("y_line"), F.col("words").alias("y_words")), ["y_doc", "y_line"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k, (x, y) in enumerate(zip(batch.column("words"), batch.column("y_words"), strict=True)):
                a, b = unpack(x.as_py()), unpack(y.as_py())
                shared = len(a) + len(b) - len(distinct(np.concatenate([a, b])))
                if 100 * shared >= THRESHOLD * (len(a) + len(b) - shared):
                    keep.append(k)
            yield batch.select(["doc", "line"]).take(pa.array(keep, pa.int64()))

    return pairs.select("doc", "line", "words", "y_words").mapInArrow(alone(work), "doc long, line int").distinct()


def matched(lines: DataFrame, again: DataFrame) -> DataFrame:
    """(doc, line) of the lines that an earlier, different line matches, without those of `again`."""
    spark, name = lines.sparkSession, ["doc", "line"]
    counts = spark.sparkContext.broadcast(rarity(lines).tobytes())  # COUNTERS of 4 bytes
    total = joinable(lines).select(F.expr(f"sum(n * {100 - THRESHOLD}L div 100 + 1)")).first()[0] or 0
    least = max(HEAVY, -(-total // HEAVY_WORDS))
    heavy = spark.sparkContext.broadcast(heavy_words(lines, counts, least))
    buckets = max(8 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_ROWS))
    pairs = stored(candidate_pairs(prefix_rows(lines, counts, heavy, buckets, least), FIRST), "line-pairs")
    tallied = pairs.where("not more").drop("more").distinct().join(again, name, "left_anti")
    found = stored(verified(tallied, lines), "line-found")
    doubtful = pairs.where("more").select(*name, F.col("y_doc").alias("word")).join(found, name, "left_anti").join(again, name, "left_anti")
    doubtful = stored(doubtful, "line-unsure")
    if not doubtful.isEmpty():  # lines whose first candidates all failed: every candidate of theirs
        rows = prefix_rows(lines, counts, heavy, buckets, least, needed(doubtful), bit_filter(doubtful.where("word is not null").select("word")))
        rest = candidate_pairs(rows, 0).drop("more").join(doubtful.select(*name).distinct(), name, "left_semi").distinct()
        found = stored(found.union(verified(rest, lines)), "line-found")
    return found


def repeated(lines: DataFrame) -> DataFrame:
    """(doc, line) of the lines that an earlier line equals: where not the line's own task has met one, one of another task, of which there is a row for each at most."""
    order = F.rank().over(Window.partitionBy("key", "bits").orderBy("doc", "line"))  # rows of repeated documents have one rank
    firsts = lines.where("not again").select("doc", "line", "key", "bits")
    return lines.where("again").select("doc", "line").union(firsts.withColumn("k", order).where("k > 1").select("doc", "line"))


def lines_with_words(text: Column) -> Column:
    """How many lines of a text have words."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D][^\\n]*"))


def with_removed(df: DataFrame, into: str, doc_id: str = "doc_id", text: str = "text", columns: list[Column] | None = None) -> DataFrame:
    """df, or these columns of it, with a column `into`: the sorted numbers of the lines of a row's text that go, null if none.

    Every row stays; a column of df of that name is replaced. The columns given, and not the texts, go through the last join.
    """
    df = df.drop(into)
    since = mark()
    docs, own = numbered(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    lines = corpus_lines(docs)
    again = stored(repeated(lines), "line-repeated")
    gone = matched(lines, again).union(again).groupBy("doc").agg(F.sort_array(F.collect_set("line")).alias("removed"))
    if own is not None:
        gone = result(gone, "line-removals", since)
        key = F.struct(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)).alias("doc"))
    else:
        gone = result(docs.select("doc_id", "dh", "doc").distinct().join(gone, "doc").drop("doc"), "line-removals", since)
        key = F.struct(F.col(doc_id).alias("doc_id"), _text_hash(F.col(text)).alias("dh"))
    columns = columns if columns is not None else [F.col(f"`{c}`") for c in df.columns]
    kept = df.select(*columns)
    own_key, held = fresh(kept, "_key"), fresh(kept, "_gone")
    rows = df.select(*columns, key.alias(own_key)).join(
        gone.select(F.struct("*").alias(held)).hint("merge"), [F.col(own_key)[c].eqNullSafe(F.col(held)[c]) for c in gone.columns[:-1]], "left"
    )
    return rows.select(*[F.col(f"`{c}`") for c in kept.columns], F.col(held)["removed"].alias(into))


def decisions(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, dh, n_lines, removed) of the distinct documents of df with words; dh is the hash of the text, removed the sorted numbers of lines that go.

    n_lines counts lines with words. Nulls: a null text has no lines; a null doc_id comes before all others.
    Rows equal in id and text are one document, whose decisions hold for each. Lines without words are never removed.
    An empty table gives an empty result. Columns of df but the two named are not read.
    """
    columns = [F.col(doc_id).alias("doc_id"), _text_hash(F.col(text)).alias("dh"), lines_with_words(F.col(text)).alias("n_lines")]
    rows = with_removed(df, "removed", doc_id, text, columns).where("n_lines > 0")
    return rows.withColumn("removed", F.coalesce("removed", F.array().cast("array<int>"))).distinct()


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", removed: str | None = None) -> DataFrame:
    """df with the lines that `decisions` removes cut out of `text`, all other columns as they are, whatever their names.

    With `removed`, a column of that name tells how many lines went. A document that loses every line it had words in is
    left out, unless `removed` is given; one that had none stays. Nulls, empty texts, repeated rows and empty tables are as in `decisions`;
    repeated rows all stay, each without the lines that go.
    """
    gone = fresh(df, "_removed")
    rows = with_removed(df, gone, doc_id, text)
    kept = F.array_join(F.filter(F.split(F.col(text), "\n", -1), lambda s, k: ~F.array_contains(F.col(gone), k)), "\n")
    lost = F.coalesce(F.size(F.col(gone)), F.lit(0))
    if removed is None:
        rows = rows.where(F.col(gone).isNull() | (lost < lines_with_words(F.col(text))))
    cut = F.when(F.col(gone).isNotNull(), kept).otherwise(F.col(text)).alias(text)
    out = [cut if c == text else F.col(f"`{c}`") for c in df.columns if c != removed]
    return rows.select(*out, *([lost.cast("long").alias(removed)] if removed else []))
