"""Operator 6: near-duplicate documents by HyperMinHash.

A document's set of word shingles is sketched by one permutation into buckets; a bucket's register
keeps the leading zeros of its least hash and a few mantissa bits. Bands of registers give candidate
groups; inside a group the collision-corrected estimate of the Jaccard index picks a spanning forest
of candidates, whose components are families; the families are compared on the full sets.

A group of more than BLOCK rows is dealt over several tasks. First each of them also gets about BLOCK pilots of the group, which
link most of a group of near copies; then only rows that these have left over are compared with all the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import alone, fresh, mark, result, stored
from hourlake.llm.graph import components
from hourlake.llm.membership import bit_filter, passing
from hourlake.llm.words import distinct, mixed, word_hashes

#: Registers of a sketch, registers of a band, and mantissa bits of a register.
REGISTERS = 128
BAND = 4
MANTISSA = 10
EMPTY = 0xFFFF
#: Standard deviations of the estimate below the threshold down to which candidates go on to the full sets: so many that the
#: estimate loses no more pairs at the threshold of 0.8 than the bands do.
DEVIATIONS = 6.0
#: Filled registers, or hashes, that a band or part has at least to make a key, and keys about that a set of fewer shingles than registers has.
FILLED, PART_KEYS = 2, 40
#: Rows of a group that one task compares with each other, beside as many pilots.
BLOCK = 512
#: Rows of a group with which one task compares all that the pilots have left over, and rows that are estimated at once.
ASKED, STRIP = 4096, 64


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `words` words; with fewer words, of the whole sequence."""
    hashes = word_hashes(text.encode("utf-8").lower())  # of bytes: ASCII letters and ASCII white space only
    n = len(hashes)
    if not n:
        return np.empty(0, np.uint64)
    span = min(words, n)
    out = np.full(n - span + 1, span, np.uint64)
    for k in range(span):
        out = (out ^ hashes[k : n - span + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return distinct(out)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers: leading zeros of a bucket's least hash, then the bits after its first one; smaller hash, larger count."""
    registers = np.full(REGISTERS, EMPTY, np.uint16)
    if not len(hashes):
        return registers
    shift = 64 - REGISTERS.bit_length() + 1
    bucket = (hashes >> np.uint64(shift)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))  # hashes are sorted: the least of each bucket
    rest = hashes[first] & np.uint64((1 << shift) - 1)
    exponent = np.frexp(rest.astype(np.float64))[1]  # position of the first one
    high = np.where(exponent > MANTISSA, rest >> np.maximum(exponent - 1 - MANTISSA, 0).astype(np.uint64), rest << np.maximum(MANTISSA + 1 - exponent, 0).astype(np.uint64))
    registers[bucket[first]] = ((np.minimum(shift - exponent, 62) << MANTISSA) | (high & np.uint64((1 << MANTISSA) - 1)).astype(np.int64)).astype(np.uint16)
    return registers


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A key for each band of registers of which FILLED are filled at least: one least hash alone would join all sets with a common shingle."""
    bands = registers.reshape(-1, BAND)
    some = np.flatnonzero((bands != EMPTY).sum(1) >= FILLED)
    keys = np.ascontiguousarray(bands[some]).view(np.uint64)[:, 0] if BAND == 4 else np.array([xxhash.xxh3_64_intdigest(b.tobytes()) for b in bands[some]], np.uint64)
    return mixed(mixed(keys) + some.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def part_keys(hashes: np.ndarray, threshold: int) -> np.ndarray:
    """Keys of a set that fills few registers, for its partners among sets of fewer than REGISTERS shingles.

    Sets of a size class that reach the threshold differ in `apart` shingles at most, so that of apart + 1 parts of the hash space one at least holds the same of both.
    There is a key for each part that holds FILLED hashes or more, of several partings, as that one part may hold fewer.
    """
    out, n = [np.empty(0, np.uint64)], len(hashes)
    top = min(100 * n // threshold, REGISTERS - 1)  # the largest set that may match
    for kind in range(n.bit_length() - 1, top.bit_length()):  # sizes from 2 ** kind to 2 ** (kind + 1) - 1 of the larger set
        apart = (100 - threshold) * ((2 << kind) - 1) // threshold
        if not apart:
            continue  # equal sets only
        parts = apart + 1
        partings = np.arange(max(2, -(-PART_KEYS // parts)), dtype=np.uint64)
        chance = mixed(hashes[None, :] ^ (partings[:, None] + np.uint64(kind << 16)) * np.uint64(0xD6E8FEB86659FD93))
        at = (chance % np.uint64(parts) + partings[:, None] * np.uint64(parts)).astype(np.int64).ravel()
        sums = np.zeros(len(partings) * parts, np.uint64)
        np.add.at(sums, at, np.tile(mixed(hashes), len(partings)))
        some = np.flatnonzero(np.bincount(at, minlength=len(sums)) >= FILLED)
        out.append(mixed(sums[some] ^ (some + (kind << 32) + (1 << 48)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return np.concatenate(out)


def keys_of(hashes: np.ndarray, registers: np.ndarray, threshold: int) -> np.ndarray:
    """The keys that a set shares with any that reaches the threshold, but for rare bad luck: of parts for partners below REGISTERS shingles, of bands for others."""
    small = part_keys(hashes, threshold) if 0 < len(hashes) < REGISTERS else np.empty(0, np.uint64)
    large = band_keys(registers) if 100 * len(hashes) >= threshold * REGISTERS else np.empty(0, np.uint64)
    return np.concatenate([small, large])


def collision_share() -> float:
    """How likely registers of two unrelated non-empty buckets agree: the leading zeros agree for a third, and all mantissa bits."""
    return 1 / 3 / (1 << MANTISSA)


def estimates(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers against rows of registers, corrected for accidental agreement."""
    same = np.empty((len(left), len(right)), np.float64)
    filled, of = (right != EMPTY).astype(np.float32), (left != EMPTY).astype(np.float32)
    right = np.where(right == EMPTY, EMPTY - 1, right).astype(np.uint16)  # no register has this value, so empty ones never agree
    for k, row in enumerate(left):
        agree = (right == row).view(np.uint64)  # bytes of 0 and 1, then of counts, added by one product; a sum over short rows is slow
        agree = np.add.reduce(np.bitwise_count(agree).view(np.uint64), 1) * np.uint64(0x0101010101010101)
        same[k] = agree >> np.uint64(56)
    total = np.maximum(of.sum(1)[:, None] + filled.sum(1)[None, :] - of @ filled.T, 1).astype(np.float64)
    chance = total * collision_share()
    return np.maximum(same - chance, 0) / np.maximum(total - chance, 1e-9)


def least_estimate(threshold: int) -> float:
    """The estimate below which a pair is no candidate for 100 * Jaccard >= threshold."""
    jaccard = threshold / 100
    return jaccard - DEVIATIONS * (jaccard * (1 - jaccard) / REGISTERS) ** 0.5


def forest(weights: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs with weight >= 0, heaviest first (Prim's method on a dense matrix)."""
    n = len(weights)
    out, best, of, left = [], np.full(n, -1.0), np.zeros(n, np.int64), np.ones(n, bool)
    for _ in range(n):
        at = int(np.argmax(np.where(left, best, -2.0)))
        if best[at] >= 0:
            out.append((int(of[at]), at))
        left[at] = False
        better = left & (weights[at] > best)
        best[better], of[better] = weights[at][better], at
    return out


def spanning(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Those pairs of n nodes, given as arrays, that join what the ones before have not: a spanning forest."""
    out, up = [], list(range(n))

    def root(k: int) -> int:
        while up[k] != k:
            up[k] = k = up[up[k]]
        return k

    for x, y in pairs:
        for a, b in zip(x.tolist(), y.tolist(), strict=True):
            if (p := root(a)) != (q := root(b)):
                up[p] = q
                out.append((a, b))
    return out


def asked_forest(registers: np.ndarray, own: np.ndarray, asking: np.ndarray, least: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of an own row of the part and an asking one whose estimate is `least` or more. Pairs of asking rows are met where one is own."""

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(own), STRIP):
            strip = own[at : at + STRIP]
            x, y = np.nonzero(estimates(registers[strip], registers[asking]) >= least)
            yield strip[x], asking[y]

    return spanning(len(registers), pairs())


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[dict[str, list]]:
    """Runs of equal first `keys` columns of sorted batches, each as its other columns' values."""
    last, held = None, None
    for batch in batches:
        names = batch.schema.names
        parts = (batch.slice(at, 256) for at in range(0, batch.num_rows, 256))
        for row in (row for part in parts for row in zip(*(c.to_pylist() for c in part.columns), strict=True)):
            if row[:keys] != last:
                if held is not None:
                    yield held
                last, held = row[:keys], {n: [] for n in names}
            for n, v in zip(names, row, strict=True):
                held[n].append(v)
    if held is not None:
        yield held


def _dealt(df: DataFrame, size: str, by: str, everywhere: Column, block: int = BLOCK) -> DataFrame:
    """Rows of groups of `size` rows dealt over `parts` parts of about `block` rows by a hash of `by`: column part; rows marked `everywhere` go to all. own: the row's own part."""
    parts = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(by), parts).cast("int")
    df = df.withColumn("parts", parts).withColumn("part", F.explode(F.when(everywhere, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(own))))
    return df.withColumn("own", F.col("part") == own)


def _pilot(size: str, by: str) -> Column:
    """About BLOCK rows of a group that has more than that, by a hash; none of others."""
    parts = F.ceil(F.col(size) / BLOCK)
    return (parts > 1) & (F.pmod(F.xxhash64(F.lit(1), by), parts) == 0)


EDGE = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def near_duplicates(df: DataFrame, words: int = 5, threshold: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash) for each row of df: documents linked where 100 * shared >= threshold * joint shingles.

    kept marks the row whose id is the least that links reach. Copies (equal sets) are one node, so they are never paired with
    each other. Every link inside a family of candidates is decided on the full sets; a pair that no other links join is lost
    if it shares no key (see keys_of) or if its estimate is below least_estimate. Each happens to less than one pair in 10**5 at the threshold, and to fewer
    above it; a test measures it on pairs of sets of many sizes.

    Nulls: a null text is an empty set, linked with nothing; a row with a null id has its component among the ids of its
    copies and links, or null if there are none. Repeated rows are copies. An empty table gives an empty result.
    """
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"))
    nodes, since = sketched(docs, words, threshold), mark()
    classes = nodes.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("least_id"), F.first("registers").alias("registers"), F.first("keys").alias("keys"))
    classes = stored(classes, "minhash-classes")
    candidates = candidate_links(classes.select("digest", "registers", "keys"), threshold)
    families = stored(_with_roots(components(candidates, "minhash-families")), "minhash-family")
    links = confirmed_links(docs.select("doc_id", "text"), classes.select("digest", "least_id"), families, words, threshold)
    joined = stored(_with_roots(components(links, "minhash-components")), "minhash-roots")
    ids = classes.select("digest", "least_id").join(joined.withColumnRenamed("node", "digest"), "digest", "left")
    ids = ids.withColumn("root", F.coalesce("root", "digest"))
    least = stored(ids.groupBy("root").agg(F.min("least_id").alias("component_id")), "minhash-least")
    ids = result(ids.select("digest", "root").join(least, "root").select("digest", "component_id"), "minhash-ids", since)
    out = nodes.select("doc_id", "n_shingles", "text_hash", "digest").join(ids, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    kept = F.col("doc_id").eqNullSafe(component)
    return out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "text_hash")


def deduplicated(df: DataFrame, words: int = 5, threshold: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df that near_duplicates keeps, with df's columns, whatever their names; of rows repeated in id and text one.

    Empty and null texts are linked with nothing, so such a row stays; so does one row with a null id whose text has no copy with an id. Of rows
    that differ in other columns alone the one whose columns come first in their order as text stays. An empty table gives an empty result.
    """
    since = mark()
    kept = near_duplicates(df, words, threshold, doc_id, text).where("kept").groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows"))
    kept = result(kept, "minhash-kept", since)
    digest, match = fresh(df, "_hash"), fresh(df, "_kept")
    rows = df.withColumn(digest, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    of = F.col(match)
    rows = rows.join(kept.select(F.struct("*").alias(match)).hint("merge"), F.col(doc_id).eqNullSafe(of["doc_id"]) & (F.col(digest) == of["text_hash"]))
    columns = [F.col(f"`{c}`") for c in df.columns]
    row, one = F.struct(*columns), fresh(df, "_row")
    first = rows.where(of["rows"] > 1).groupBy(of["doc_id"], of["text_hash"]).agg(F.min_by(row, F.to_json(row)).alias(one))
    return rows.where(of["rows"] == 1).select(*columns).union(first.select(*[F.col(one)[c].alias(c) for c in df.columns]))


def sketched(docs: DataFrame, words: int, threshold: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, digest, registers, keys) of documents (doc_id, text, text_hash), stored. Equal sets have equal digests."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["n_shingles", "digest", "registers", "keys"], [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        for batch in batches:
            rows = []
            for text in batch.column(1):
                hashes = shingle_set(text.as_py() or "", words)
                registers = sketch(hashes)
                rows.append((len(hashes), xxhash.xxh3_128_digest(hashes.tobytes()), registers.tobytes(), keys_of(hashes, registers, threshold).view(np.int64)))
            columns = zip(*rows, strict=True) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["doc_id", "text_hash", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.mapInArrow(alone(work), f"doc_id {kind}, text_hash long, n_shingles long, digest binary, registers binary, keys array<long>"), "minhash-nodes")


def _edges(names: list[bytes], edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([names[e[k]] for e in edges], pa.binary()) for k in (0, 1)], schema=EDGE)


def _candidate_groups(classes: DataFrame) -> DataFrame:
    """(band, n, digest) of the bands that n > 1 sets share, stored; of bands that the same sets share only one."""
    bands = classes.select("digest", F.explode("keys").alias("band"))
    shared = stored(bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "minhash-bands")
    held = bit_filter(shared.select("band"))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(passing(held, batch.column("band")))

    members = stored(bands.mapInArrow(alone(some), "digest binary, band long").join(shared, "band"), "minhash-members")
    alike = members.groupBy("band", "n").agg(F.bit_xor(F.xxhash64("digest")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "digest")).alias("y"))
    chosen = stored(alike.groupBy("n", "x", "y").agg(F.min("band").alias("band")).select("band"), "minhash-groups")
    return stored(members.join(chosen, "band"), "minhash-members")


def candidate_links(classes: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) that join all pairs which share a band and whose estimate is near the threshold, stored.

    Of a group that one task holds they are a spanning forest of these pairs. Of larger ones all rows that are linked with any in their part
    are joined, which may join more than those pairs; rows that are not are compared with the whole group.
    """
    least = least_estimate(threshold)
    members = _candidate_groups(classes)

    def compared(rows: DataFrame, asks: bool) -> DataFrame:
        registers = classes.select("digest", "registers")
        if asks:  # few of them
            held = bit_filter(rows.select(F.xxhash64("digest")))

            def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    yield batch.filter(passing(held, batch.column("h"))).select(["digest", "registers"])

            registers = registers.withColumn("h", F.xxhash64("digest")).mapInArrow(alone(some), "digest binary, registers binary")
        rows = rows.join(registers, "digest").select("band", "part", "parts", "own", "marked", "digest", "registers")
        rows = rows.repartition("band", "part").sortWithinPartitions("band", "part")

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for g in groups(batches, 2):
                names = g["digest"]
                if len(names) < 2 and g["parts"][0] == 1:
                    continue
                registers = np.stack([np.frombuffer(r, np.uint16)[:REGISTERS] for r in g["registers"]])
                own, marked = (np.flatnonzero(np.array(g[c], bool)) for c in ("own", "marked"))
                if asks:  # marked rows are those left over, which all parts have
                    edges = asked_forest(registers, own, marked, least)
                elif g["parts"][0] == 1:
                    weights = estimates(registers, registers)
                    np.fill_diagonal(weights, -1)
                    weights[weights < least] = -1
                    edges = forest(weights)
                else:  # marked rows are the pilots, which all parts have
                    weights = estimates(registers[own], registers)
                    weights[np.arange(len(own)), own] = -1
                    linked = (weights >= least).any(1)
                    hub = min(marked.tolist(), key=lambda k: names[k]) if len(marked) else 0
                    edges = [(hub, k) for k in own[linked].tolist() if k != hub]
                    left = [names[k] for k in own[~linked].tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.nulls(len(left), pa.binary()), pa.array([g["band"][0]] * len(left), pa.int64())], ["a", "b", "band"])
                found = _edges(names, edges)
                yield pa.RecordBatch.from_arrays([*found.columns, pa.nulls(len(edges), pa.int64())], ["a", "b", "band"])

        return rows.mapInArrow(alone(work), "a binary, b binary, band long")

    first = _dealt(members, "n", "digest", _pilot("n", "digest")).withColumn("marked", _pilot("n", "digest"))
    found = stored(compared(first, False), "minhash-candidates")
    links, left = found.where("b is not null").select("a", "b"), found.where("b is null").select(F.col("a").alias("digest"), "band")
    if left.isEmpty():
        return links
    marked = members.join(left.select("band").distinct(), "band", "left_semi").join(left.withColumn("marked", F.lit(True)), ["band", "digest"], "left")
    marked = marked.withColumn("marked", F.coalesce("marked", F.lit(False)))
    rest = compared(_dealt(stored(marked, "minhash-marked"), "n", "digest", F.col("marked"), ASKED), True)
    return stored(links.union(rest.select("a", "b")), "minhash-candidates")


def _with_roots(found: DataFrame) -> DataFrame:
    """(node, root), with the roots themselves."""
    return found.union(found.select("root", "root").distinct())


def confirmed_links(docs: DataFrame, classes: DataFrame, families: DataFrame, words: int, threshold: int) -> DataFrame:
    """True links (a, b) from the full sets, stored, whose components in each family (node, root) are those of all its true links."""
    sizes = stored(families.groupBy("root").agg(F.count("*").alias("n")), "minhash-sizes")
    members = families.join(sizes, "root").join(classes, families["node"] == classes["digest"]).select("digest", "least_id", "root", "n")
    members = stored(members, "minhash-members")

    def sets_of(some: DataFrame) -> DataFrame:
        """(digest, hashes) of the members given, and of few others: made again from the texts."""
        needed = bit_filter(some.select(F.xxhash64("least_id")))

        def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                batch = batch.filter(passing(needed, batch.column(1)))
                for at in range(0, batch.num_rows, 512):
                    sets = [shingle_set(t.as_py() or "", words).tobytes() for t in batch.column(0).slice(at, 512)]
                    yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()), pa.array(sets, pa.binary())], ["digest", "hashes"])

        sets = docs.select("text", F.xxhash64("doc_id").alias("h")).mapInArrow(alone(to_sets), "digest binary, hashes binary")
        return sets.groupBy("digest").agg(F.first("hashes").alias("hashes"))

    def compared(some: DataFrame, everywhere: Column, asks: bool = False) -> DataFrame:
        rows = _dealt(some.withColumn("marked", everywhere), "n", "digest", F.col("marked")).join(sets_of(some), "digest").select("root", "part", "own", "marked", "digest", "hashes")
        rows = rows.repartition("root", "part").sortWithinPartitions("root", "part")

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for g in groups(batches, 2):
                names, sets = g["digest"], [np.frombuffer(h, np.uint64) for h in g["hashes"]]
                own, marked = (np.flatnonzero(np.array(g[c], bool)) for c in ("own", "marked"))
                edges = asked_true_forest(sets, own, marked, threshold) if asks else true_forest(sets, threshold)
                if edges:
                    yield _edges(names, edges)

        return rows.mapInArrow(alone(work), "a binary, b binary")

    links = stored(compared(members, _pilot("n", "digest")), "minhash-links")
    large = members.where(F.col("n") > BLOCK)
    if large.isEmpty():
        return links
    # What the pilots have left outside the largest component of its family is compared with the whole family.
    joined = _with_roots(components(links, "minhash-parts")).select(F.col("node").alias("digest"), F.col("root").alias("component"))
    large = stored(large.join(joined, "digest", "left").withColumn("component", F.coalesce("component", "digest")), "minhash-large")
    most = large.groupBy("root", "component").agg(F.count("*").alias("m")).groupBy("root").agg(F.max(F.struct("m", "component")).alias("most"))
    marked = large.join(stored(most.where("most.m > 0").select("root", "most.component"), "minhash-most").withColumnRenamed("component", "largest"), "root")
    marked = stored(marked.select("digest", "least_id", "root", "n", (F.col("component") != F.col("largest")).alias("left")), "minhash-left")
    if marked.where("left").isEmpty():
        return links
    marked = marked.join(marked.where("left").select("root").distinct(), "root", "left_semi")
    return stored(links.union(compared(stored(marked, "minhash-marked"), F.col("left"), True)), "minhash-links")


def true_forest(sets: list[np.ndarray], threshold: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets with 100 * shared >= threshold * joint, all pairs compared on bit rows."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    if n < 2:
        return []
    owner = np.repeat(np.arange(n), sizes)
    values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = counts > 1  # hashes of one set alone are shared with none
    column = np.cumsum(common) - 1
    keep = common[place]
    width = (int(common.sum()) + 63) // 64
    bits = np.zeros((n, max(width, 1)), np.uint64)
    at = column[place[keep]]
    np.bitwise_or.at(bits, (owner[keep], at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    edges, left = [], np.ones(n, bool)
    for start in range(n):
        if not left[start]:
            continue
        left[start] = False
        todo = [start]
        while todo:
            at = todo.pop()
            rest = np.flatnonzero(left)
            if not len(rest):
                break
            shared = np.bitwise_count(bits[rest] & bits[at]).sum(1).astype(np.int64)
            hit = rest[100 * shared >= threshold * (sizes[rest] + sizes[at] - shared)]
            left[hit] = False
            edges += [(at, int(h)) for h in hit]
            todo += hit.tolist()
    return edges


def asked_true_forest(sets: list[np.ndarray], own: np.ndarray, asking: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of an own row of the part and an asking one with 100 * shared >= threshold * joint. Pairs of asking rows are met where one is own.

    The own rows' hashes are held sorted, with their rows; an asking row counts those that it has.
    """
    if not len(own):
        return []
    sizes = np.array([len(s) for s in sets])
    hashes = np.concatenate([sets[k] for k in own.tolist()])
    order = np.argsort(hashes)
    hashes, owner = hashes[order], np.repeat(np.arange(len(own)), sizes[own])[order]

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in asking.tolist():
            first, last = hashes.searchsorted(sets[at]), hashes.searchsorted(sets[at], "right")
            n = last - first
            shared = np.bincount(owner[np.repeat(last - np.cumsum(n), n) + np.arange(n.sum())], minlength=len(own))
            hit = own[100 * shared >= threshold * (sizes[own] + sizes[at] - shared)]
            yield hit, np.full(len(hit), at)

    return spanning(len(sets), pairs())
