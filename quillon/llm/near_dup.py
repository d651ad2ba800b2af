"""Near-duplicates by HyperMinHash.

A document's set of word shingles becomes a sketch of 120 registers. A hash
falls to a register by its value; the register keeps, for the least hash that
fell to it, the number of leading zeros and the ten bits after the first one:
two bytes. Bands of the compressed registers give candidates. Jaccard
similarity is estimated from equal registers, corrected for those that are equal
by chance, before candidates are verified on full sets.

Equal sets are one class from the start. Within a band's bucket, documents whose
registers differ in no more than links can differ in form groups, each with a
leader: a shingle changes one register at most. Full sets are
then held against the leader's only, and each document is reduced to what it
lacks and what it adds; from these, the similarity of any two documents of a
group follows exactly. That leaves no pair within a group to be emitted: a
group gives as many links as it has members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.components import components
from quillon.llm.text import lower_ascii, words
from quillon.session import materialise

REGISTERS = 120
MANTISSA = 10
#: An empty register.
EMPTY = np.uint16(0xFFFF)
#: Registers that a document may differ in from one in the net, and the ratio of their sizes, to be left out of it.
UNLIKE, NET = 3, 0.97
#: Documents of a part of a bucket; of a part of a leader's members.
PART, MEMBERS = 1024, 256


def shingle_hashes(text: Column, n: int) -> Column:
    """Hashes of the n-word shingles in order, repeated ones too; of all words where there are fewer; none without words.

    text is an array of words.
    """
    size = F.size(text)
    return (
        F.when(size == 0, F.array().cast("array<bigint>"))
        .when(size < n, F.array(F.xxhash64(text)))
        .otherwise(F.transform(F.sequence(F.lit(0), size - n), lambda i: F.xxhash64(*[F.get(text, i + k) for k in range(n)])))
    )


def _hashed(docs: DataFrame, n: int) -> DataFrame:
    base = docs.select("doc_id", words(lower_ascii(F.coalesce(F.col("text"), F.lit("")))).alias("_w"))
    return base.select("doc_id", shingle_hashes(F.col("_w"), n).alias("hashes"))


def sketch(values: np.ndarray) -> np.ndarray:
    """The registers of a set of 64-bit hashes."""
    out = np.full(REGISTERS, EMPTY, np.uint16)
    if not len(values):
        return out
    v = values.view(np.uint64)
    register = (v >> np.uint64(40)) % np.uint64(REGISTERS)  # 24 bits choose the register
    rest = v & np.uint64((1 << 40) - 1)  # 40 bits compete
    least = np.full(REGISTERS, 1 << 40, np.uint64)
    np.minimum.at(least, register.astype(np.intp), rest)
    full = least < np.uint64(1 << 40)
    m = least[full] + np.uint64(1)
    exponent = np.frexp(m.astype(np.float64))[1] - 1  # position of the first one, 0 to 40
    zeros = (40 - exponent).astype(np.uint64)
    shift = exponent - MANTISSA
    bits = np.where(shift >= 0, m >> np.maximum(shift, 0).astype(np.uint64), m << np.maximum(-shift, 0).astype(np.uint64))
    mantissa = bits & np.uint64((1 << MANTISSA) - 1)
    out[full] = (zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    return out


def estimate(a: np.ndarray, many: np.ndarray, n: float, sizes: np.ndarray) -> np.ndarray:
    """Jaccard similarity of sketch a with the rows of many, corrected for registers that are equal by chance.

    Where both registers hold something, unlike minima agree in zeros and
    mantissa with a chance of about 0.17 / 2**10, less for unlike sizes.
    """
    empty = a == EMPTY
    if empty.any():
        equal = (many[:, ~empty] == a[~empty]).sum(axis=1)
        used = np.maximum(1, REGISTERS - (many[:, empty] == EMPTY).sum(axis=1))
    else:
        equal, used = (many == a).sum(axis=1), REGISTERS
    chance = 0.1699 / 2**MANTISSA * 4 * n * sizes / np.maximum(1.0, (n + sizes) ** 2)
    return np.clip((equal / used - chance) / (1 - chance), 0, 1)


def band_rows(threshold: float) -> int:
    """Registers of a band: as many as still let two sets at the threshold share a band but for one case in a million."""
    return max(r for r in (1, 2, 3, 4, 5, 6, 8) if (1 - threshold**r) ** (REGISTERS // r) <= 1e-6 or r == 1)


def sketches(docs: DataFrame, n: int, threshold: float) -> DataFrame:
    """(doc_id, n_shingles, digest, sketch, bands) of each row; digest tells equal sets, bands are hashes with their number."""
    hashed = _hashed(docs, n)
    rows = band_rows(threshold)
    id_type = hashed.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            ns, digests, regs, bands = [], [], [], []
            for i in range(len(column)):
                v = np.unique(flat[at[i] : at[i + 1]])
                ns.append(len(v))
                digests.append(hashlib.blake2b(v.tobytes(), digest_size=16).digest() if len(v) else None)
                s = sketch(v)
                regs.append(s.tobytes())
                parts = s[: REGISTERS // rows * rows].reshape(-1, rows)
                bands.append([int.from_bytes(hashlib.blake2b(bytes([b]) + parts[b].tobytes(), digest_size=8).digest(), "little", signed=True) for b in np.flatnonzero((parts != EMPTY).any(axis=1))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int64()), pa.array(digests, pa.binary()), pa.array(regs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "sketch", "bands"],
            )

    return hashed.mapInArrow(run, f"doc_id {id_type}, n_shingles long, digest binary, sketch binary, bands array<long>")


def _groups(rows: DataFrame, threshold: float, steps: int) -> DataFrame:
    """rows: (bucket, i, j, doc_id, n_shingles, sketch), a part's rows together. Returns (bucket, leader, doc_id, stand).

    In each part (bucket, i, j), documents that may be linked by their sizes and
    registers are of one group, and so are those that such ones tie together; its
    first document leads it. No link is left out: two sets that meet the threshold
    lack (1 - threshold) / (1 + threshold) of their sizes' sum in common at most,
    and each shingle that only one of them has changes one register. Only a net of
    the part is kept for comparing: what differs from one in the net in UNLIKE
    registers or fewer, and hardly in size, is not added to it: that one stands
    for it (stand, null where j is 0; a document of the net stands for itself). For each of the
    steps by which two compared documents may stand for others, so many registers
    more may differ, and the sizes by NET more. Documents in no group are left
    out, but for those of a net where j isn't 0.
    """
    share = (1 - threshold) / (1 + threshold) / NET**steps + 1e-9
    ratio = threshold * NET**steps - 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size = None, 0
        net = np.zeros(16, np.intp)
        ns = np.zeros(16)
        regs = np.zeros((16, REGISTERS), np.uint16)
        ids: list[int] = []
        root: list[int] = []
        stand: list[int] = []

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        def told() -> pa.RecordBatch:
            tops = [find(i) for i in range(len(ids))]
            more = {t for i, t in enumerate(tops) if t != i}
            kept = set(net[:size].tolist()) if part[2] else set()
            some = [(part[0], ids[t], x, ids[stand[i]] if part[2] else None) for i, (t, x) in enumerate(zip(tops, ids, strict=True)) if t in more or i in kept]
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in some], pa.int64()) for k in range(4)], names=["bucket", "leader", "doc_id", "stand"])

        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            docs, counts, data = batch.column(3).to_pylist(), batch.column(4).to_numpy(), batch.column(5).to_pylist()
            for key, doc, n, raw in zip(keys, docs, counts, data, strict=True):
                s = np.frombuffer(raw, np.uint16)
                if key != part:
                    if ids:
                        yield told()
                    part, size = key, 0
                    for x in (ids, root, stand):
                        x.clear()
                me = len(ids)
                ids.append(doc)
                root.append(me)
                stand.append(me)
                if size:
                    unlike = np.count_nonzero(regs[:size] != s, axis=1)
                    larger = np.maximum(ns[:size], n)
                    smaller = np.minimum(ns[:size], n)
                    for k in np.flatnonzero((unlike <= share * (ns[:size] + n) + steps * UNLIKE) & (smaller >= ratio * larger)):
                        u, v = find(me), find(int(net[k]))
                        root[max(u, v)] = min(u, v)
                    near = np.flatnonzero((unlike <= UNLIKE) & (smaller >= NET * larger))
                    if len(near):
                        stand[me] = int(net[near[0]])
                if stand[me] == me:
                    if size == len(ns):
                        net, ns, regs = np.concatenate([net, net]), np.concatenate([ns, ns]), np.concatenate([regs, regs])
                    net[size], ns[size], regs[size] = me, n, s
                    size += 1
        if ids:
            yield told()

    return rows.mapInArrow(run, "bucket long, leader long, doc_id long, stand long")


def _stars(reps: DataFrame, threshold: float) -> DataFrame:
    """(leader, doc_id): documents that share a bucket and may be linked by their sizes and sketches.

    A bucket of very many documents is dealt out to parts, each of which forms its
    groups alone; the nets of its parts are then held against each other, in pairs
    of parts where they are still many. So no task has a whole large bucket. What
    documents of the nets stand for is of their group then, too: two documents of
    unlike parts may be linked where those that stand for them aren't.
    """
    banded = reps.select("doc_id", F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    busy = materialise(banded.join(sizes, "bucket").select("bucket", "doc_id", F.ceil(F.col("_n") / PART).cast("int").alias("parts")))
    slim = reps.select("doc_id", "n_shingles", "sketch")
    first = busy.withColumn("i", F.pmod(F.xxhash64("doc_id"), "parts").cast("int")).join(slim, "doc_id")
    first = first.select("bucket", "i", (F.col("parts") > 1).cast("int").alias("j"), "doc_id", "n_shingles", "sketch").repartition("bucket", "i").sortWithinPartitions("bucket", "i", "doc_id")
    own = materialise(_groups(first, threshold, 1))
    stars = own.where("leader <> doc_id").select("leader", "doc_id")

    dealt = own.where("stand is not null")
    nets = dealt.where("doc_id = stand").select("bucket", "doc_id")
    counts = nets.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("_of"))
    placed = nets.join(counts, "bucket").withColumn("_own", F.pmod(F.xxhash64(F.lit(1), "doc_id"), "_of").cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_of") - 1)))
    placed = placed.select("bucket", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), "doc_id").join(slim, "doc_id")
    placed = placed.select("bucket", "i", "j", "doc_id", "n_shingles", "sketch").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "doc_id")
    among = materialise(_groups(placed, threshold, 3).where("leader <> doc_id").select("bucket", F.col("leader").alias("first"), F.col("doc_id").alias("stand")).distinct())
    among = among.union(among.select("bucket", "first", F.col("first").alias("stand")).distinct())
    across = materialise(among.join(dealt, ["bucket", "stand"]).select("bucket", "first", "leader", "doc_id"))
    # What one group of a part holds has its leader already.
    several = across.groupBy("bucket", "first").agg(F.min("leader").alias("_a"), F.max("leader").alias("_b")).where("_a < _b").select("bucket", "first")
    across = across.join(several, ["bucket", "first"]).where("first <> doc_id").select(F.col("first").alias("leader"), "doc_id")
    pairs = materialise(stars.union(across).distinct())
    return materialise(pairs.union(pairs.select("leader", F.col("leader").alias("doc_id")).distinct()))


def _links_of_part(threshold_percent: int):
    """From a part of a leader's strays (sides 0 and 2) and one of its members (sides 1 and 2) to links between their classes: a forest."""

    def run(table: pa.Table) -> pa.Table:
        n, label = table.column("n_shingles").to_numpy(), table.column("class").to_numpy()
        core = table.column("core").to_numpy()  # shingles shared with the leader
        leader_n, side = int(table.column("leader_n")[0].as_py()), table.column("side").to_numpy()
        # Equal numbers for equal lacks (of the leader's shingles) and equal additions.
        bits: list[np.ndarray] = []
        for name in ("lacks", "adds"):
            c = table.column(name).combine_chunks()
            flat, at = c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy()
            flat, at = flat[at[0] : at[-1]], at - at[0]
            values, code, often = np.unique(flat, return_inverse=True, return_counts=True)
            row = np.repeat(np.arange(len(n)), np.diff(at))
            shared = often[code] > 1 if len(values) else np.zeros(0, bool)
            _, packed = np.unique(code[shared], return_inverse=True)
            width = (int(packed.max()) // 64 + 1) if len(packed) else 0
            m = np.zeros((len(n), width), np.uint64)
            if width:
                np.bitwise_or.at(m, (row[shared], packed // 64), np.uint64(1) << (packed % 64).astype(np.uint64))
            bits.append(m)
        lacks, adds = bits
        n_lacks = leader_n - core
        distance = 1 - core / (n + leader_n - core)
        reach = 1 - threshold_percent / 100 + 1e-9
        members, now = np.flatnonzero(side > 0), label.copy()
        found: list[tuple[int, int]] = []
        for i in np.flatnonzero(side != 1).tolist():
            # All of other classes that may link by the triangle inequality over the leader.
            k = members[(now[members] != now[i]) & (np.abs(distance[members] - distance[i]) <= reach)]
            both_lack = np.bitwise_count(lacks[k] & lacks[i]).sum(axis=1, dtype=np.int64)
            both_add = np.bitwise_count(adds[k] & adds[i]).sum(axis=1, dtype=np.int64)
            inter = leader_n - n_lacks[k] - n_lacks[i] + both_lack + both_add
            for j in k[inter * 100 >= threshold_percent * (n[i] + n[k] - inter)].tolist():
                if now[i] != now[j]:
                    now[now == now[j]] = now[i]
                    found.append((i, j))
        return pa.table({"a": pa.array(label[[f[0] for f in found]], pa.int64()), "b": pa.array(label[[f[1] for f in found]], pa.int64())})

    return run


def _classed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """members of leaders with several classes, each with its class by labels (node, component); stray are those outside of the leader's largest class."""
    each = members.join(labels.withColumnRenamed("node", "class"), "class", "left")
    each = each.withColumn("class", F.coalesce("component", "class")).drop("component")
    counts = each.groupBy("leader", "class").agg(F.count(F.lit(1)).alias("_n"))
    largest = counts.groupBy("leader").agg(F.max(F.struct("_n", "class")).alias("_most"), F.sum("_n").alias("_all")).where("_most._n < _all")
    sized = each.join(largest, "leader").withColumn("stray", F.col("class") != F.col("_most.class"))
    parts = lambda c: F.ceil(c / MEMBERS).cast("int")
    return sized.withColumns({"_parts": parts(F.col("_all")), "_strays": parts(F.col("_all") - F.col("_most._n"))}).drop("_most", "_all")


SIDED = ("leader", "i", "j", "side", "class", "n_shingles", "leader_n", "core", "lacks", "adds")


def _own_parts(classed: DataFrame) -> DataFrame:
    """(leader, i, j, side, ...): each part i of a leader's members alone; strays are of side 2. j is 0."""
    own = F.pmod(F.xxhash64("doc_id"), "_parts").cast("int")
    return classed.select("*", own.alias("i"), F.lit(0).alias("j"), F.when(F.col("stray"), 2).otherwise(1).alias("side")).select(*SIDED)


def _parted(classed: DataFrame) -> DataFrame:
    """(leader, i, j, side, ...): each part i of a leader's strays (side 0) beside each part j of all its members (side 1)."""
    sized = classed.withColumn("_h", F.xxhash64("doc_id"))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    part = lambda c: F.pmod("_h", c).cast("int")
    strays = sized.where("stray").withColumn("i", part("_strays")).withColumn("j", every("_parts")).withColumn("side", F.lit(0))
    others = sized.withColumn("j", part("_parts")).withColumn("i", every("_strays")).withColumn("side", F.lit(1))
    return strays.select(*SIDED).union(others.select(*SIDED))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """For each row of docs: doc_id, n_shingles, component_id and kept.

    docs needs doc_id (a whole number) and text; other columns are ignored.
    Words are `[^\\x20\\x09-\\x0D]+` after A-Z became lower case. A document's
    set holds its distinct n-word shingles; with fewer words, the whole sequence
    as one. Documents with |A and B| * 100 >= percent * |A or B| are linked.
    component_id is the smallest doc_id reachable, and kept says that it is the
    document's own.

    Null texts and texts without words have an empty set and are linked with
    nothing. Repeated rows give repeated rows; rows that repeat a doc_id must
    have the same text, or any one of them counts. A null doc_id is in no
    component and is kept. An empty table gives no rows.
    """
    threshold = percent / 100
    rows = materialise(sketches(docs.select("doc_id", "text"), n, threshold))
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    classes = materialise(rows.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")))
    reps = rows.join(classes.select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    reps = materialise(reps.select("doc_id", "n_shingles", "sketch", "bands"))

    links = _links(docs, reps, n, percent)
    roots = components(links)
    label = classes.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("digest", F.coalesce("component", "doc_id").alias("_component"))
    label = materialise(label)
    # Slim rows; a class with very many of them is dealt anew by AQE, as the join can be split.
    out = rows.select("doc_id", "n_shingles", "digest").join(label, "digest", "left")
    component = F.coalesce(F.col("_component"), F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _links(docs: DataFrame, reps: DataFrame, n: int, percent: int) -> DataFrame:
    stars = _stars(reps, percent / 100)
    ids = materialise(stars.select("doc_id").distinct())
    near = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    sets = _hashed(near, n).select("doc_id", F.array_distinct("hashes").alias("set")).dropDuplicates(["doc_id"])
    sets = materialise(sets)

    lead = sets.select(F.col("doc_id").alias("leader"), F.col("set").alias("leader_set"))
    pairs = stars.join(sets, "doc_id").join(lead, "leader")
    inter = F.size("set") - F.size("adds")
    members = pairs.select("leader", "doc_id", "set", "leader_set", F.array_except("set", "leader_set").alias("adds"), F.array_except("leader_set", "set").alias("lacks"))
    members = members.select(
        "leader", "doc_id", F.size("set").cast("long").alias("n_shingles"), F.size("leader_set").cast("long").alias("leader_n"), inter.cast("long").alias("core"), "lacks", "adds",
    )
    members = materialise(members.withColumn("linked", F.col("core") * 100 >= percent * (F.col("n_shingles") + F.col("leader_n") - F.col("core"))))
    # Classes before links: what the leaders' own links hold together is compared no more, then what one part's links do. So the parts of large
    # groups give links between the few classes that are left, and no forest of documents each.
    held = components(members.where("linked").select(F.col("leader").alias("a"), F.col("doc_id").alias("b")))
    links = held.select(F.col("component").alias("a"), F.col("node").alias("b"))
    found = lambda parts: materialise(parts.repartition("leader", "i", "j").groupBy("leader", "i", "j").applyInArrow(_links_of_part(percent), "a long, b long").distinct())
    classed = materialise(_classed(members.withColumn("class", F.col("doc_id")), held))
    own = found(_own_parts(classed))
    classed = _classed(classed.where("_parts > 1").drop("stray", "_parts", "_strays"), components(own))
    return links.union(own).union(found(_parted(materialise(classed))))


def first_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """docs without near-duplicates: of each component, the document with the smallest doc_id stays. Columns are those of docs."""
    gone = materialise(near_duplicates(docs, n, percent).where("not kept").select("doc_id").distinct())
    same = docs["doc_id"] == gone["doc_id"]
    return docs.join(gone, same, "left_anti")
