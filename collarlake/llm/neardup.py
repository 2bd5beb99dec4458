"""Near-duplicate groups by SuperMinHash signatures.

A document's set holds the hashes of its distinct shingles of five words; a text with fewer
words has one shingle, the whole sequence. Documents with 100 * |A n B| >= 75 * |A u B|
are linked, and linked documents form groups.

1. One pass over the texts gives per document the size of its set, a 128-bit hash of the
   set, and a signature: SuperMinHash gives every element a random permutation of the
   components; the rank that a component has in it, plus a random fraction, is the
   element's value there, and the component keeps the least. Values of one element are
   correlated such that they spread evenly, hence less variance than independent ones,
   and an element stops at the first rank above all components' least values.
2. Documents with equal sets become one class, represented by their least doc_id. Groups
   of copies are counted here, with a partial step, and never meet as rows again.
3. Bands of the signature are the keys of buckets. With 40 bands of 5 a link of similarity
   0.75 is missed with probability 2e-5, and a closer one hardly ever.
4. The members of a bucket are compared, on full sets, with its center, the member that
   lies in the most and largest buckets. All that are compared with a center are its family.
5. Groups are found by union-find over all tasks: trees are hooked to the least neighbour
   and compressed by pointer jumping.
6. Two members x, y of a family may be linked although x, a stray, is not linked to the
   center c. They share at most min(|x n c|, |y n c|) elements of c. Where that is too
   little for a link they must share an element outside of c, and one of the least such
   elements (a prefix, since not all of those that they need can be missed). Members that
   share one are candidates; pairs for which the shared part of c could be enough, by
   their sizes, are candidates as well. Where few members share an element, their pairs
   are compared. Where many do, the strays of the family are compared with its other
   candidates in blocks, each of which holds a bounded number of full sets and gives only
   the links that it finds.

So no link between members of a bucket is left out, while a bucket of near copies gives one
comparison per member and not one per pair.

Intermediate tables are written to the shared folder. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from collarlake.llm.tables import Saved, freed, importable
from collarlake.llm.words import mix, randoms, text_bytes, word_hashes

SHINGLE = 5
PERCENT = 75
COMPONENTS = 200
BANDS = 40
ROWS = COMPONENTS // BANDS
ELEMENTS = 8192
SMALL = 32  # members that share an element and are compared with each other
BLOCK = 256  # sets of each side of a block
SIZE_STEP = 1.02  # sizes are looked up in classes that grow by this factor

_PARTS = randoms(3 << 40, 1, SHINGLE + 1) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Per text the sorted hashes of its distinct shingles."""
    words, offsets = word_hashes(*text_bytes(column))
    for begin, end in zip(offsets[:-1], offsets[1:], strict=True):
        own = words[begin:end]
        if len(own) >= SHINGLE:
            size = len(own) - SHINGLE + 1
            total = own[:size] * _PARTS[0]
            for k in range(1, SHINGLE):
                total += own[k : k + size] * _PARTS[k]
            yield np.unique(mix(total))
        elif len(own):
            whole = (own * _PARTS[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
            yield mix(np.array([whole], np.uint64))
        else:
            yield own


def super_min_hash(elements: np.ndarray, components: int = COMPONENTS) -> np.ndarray:
    """The signature of a set of 64-bit hashes, rank plus fraction for each component.

    All elements of a block take a step of their permutations at once. An element's state
    depends on itself only, so the blocks' order and size do not change the result.
    """
    least = np.full(components, np.inf)
    for begin in range(0, len(elements), ELEMENTS):
        block = elements[begin : begin + ELEMENTS]
        rows = np.arange(len(block))
        order = np.tile(np.arange(components, dtype=np.int32), (len(block), 1))
        state = mix(block ^ _STEP)
        for rank in range(components):
            if rank > least.max():
                break
            state = state + _STEP
            drawn = mix(state)
            pick = rank + ((drawn & np.uint64(0xFFFFF)) * np.uint64(components - rank) >> np.uint64(20)).astype(np.int64)
            at = order[rows, pick]
            order[rows, pick] = order[:, rank]
            value = rank + (drawn >> np.uint64(20)) * (1.0 / (1 << 44))
            np.minimum.at(least, at, value)
    return least


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key per band, different between bands."""
    bits = signature.view(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * _STEP + bits[:, k])
    return key


_SIGNED = "doc_id long, n_shingles long, hi long, lo long, bands array<long>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, his, los, keys = [], [], [], []
        for elements in shingle_sets(batch.column("text")):
            sizes.append(len(elements))
            spread = mix(elements + _STEP)
            his.append(elements.sum(dtype=np.uint64))
            los.append(spread.sum(dtype=np.uint64))
            if len(elements):
                keys.append(band_keys(super_min_hash(elements)))
            else:
                keys.append(np.zeros(0, np.uint64))
        ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        flat = np.concatenate([*keys, np.zeros(0, np.uint64)]).view(np.int64)
        as_long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(sizes, pa.int64()),
                as_long(his),
                as_long(los),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            ],
            names=["doc_id", "n_shingles", "hi", "lo", "bands"],
        )


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, hi, lo, bands) of every document. The set hash (hi, lo)
    is equal for equal sets. A text without words has an empty set and no bands."""
    importable(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(freed(_sign), _SIGNED)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document the full set, as bytes of sorted 64-bit numbers. Rows that share a
    representative's id but not its set are left out."""
    for batch in batches:
        ids, sets = [], []
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "hi", "lo")]
        for doc_id, hi, lo, elements in zip(*columns, shingle_sets(batch.column("text")), strict=True):
            sums = np.array([elements.sum(dtype=np.uint64), mix(elements + _STEP).sum(dtype=np.uint64)])
            if sums.view(np.int64).tolist() == [hi, lo]:
                ids.append(doc_id)
                sets.append(elements.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["id", "elements"]
        )


_COMPARED = "u long, v long, linked boolean, shared long, size long, other long, prefix array<long>"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v) with full sets a and b: whether they are linked, how much they share,
    their sizes, and the least elements of a outside of b, as many as a link of u with
    another document of v's family needs to meet."""
    for batch in batches:
        linked, shared, sizes, others, prefixes = [], [], [], [], []
        for a, b in zip(batch.column("a"), batch.column("b"), strict=True):
            x = np.frombuffer(a.as_buffer(), np.uint64)
            y = np.frombuffer(b.as_buffer(), np.uint64)
            at = np.searchsorted(y, x)
            in_y = y[np.minimum(at, len(y) - 1)] == x
            both = int(in_y.sum())
            linked.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            shared.append(both)
            sizes.append(len(x))
            others.append(len(y))
            # A link shares at least PERCENT of x, at most ``both`` of that with the center.
            outside = max(1, -(-PERCENT * len(x) // 100) - both)
            prefixes.append(x[~in_y][: max(0, len(x) - both - outside + 1)].view(np.int64))
        ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
        flat = np.concatenate([*prefixes, np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("u"),
                batch.column("v"),
                pa.array(linked, pa.bool_()),
                *(pa.array(c, pa.int64()) for c in (shared, sizes, others)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            ],
            names=["u", "v", "linked", "shared", "size", "other", "prefix"],
        )


def full_sets(docs: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, elements) of the classes in ``ids`` (id), one row each, from the texts."""
    wanted = ids.join(classes.select("id", "hi", "lo"), "id")
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("id"))
    return texts.select("doc_id", "text", "hi", "lo").mapInArrow(_sets, "id long, elements binary")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """What ``_compare`` says of ``pairs`` (u, v)."""
    a = sets.select(F.col("id").alias("u"), F.col("elements").alias("a"))
    b = sets.select(F.col("id").alias("v"), F.col("elements").alias("b"))
    both = pairs.join(a, "u").join(b, "v")
    return both.select("u", "v", "a", "b").mapInArrow(_compare, _COMPARED)


def families(buckets: DataFrame, saved: Saved) -> DataFrame:
    """(u, v): each member of a bucket (key, size, id) with the bucket's center."""
    weight = buckets.groupBy("id").agg(F.sum("size").alias("weight"))
    rank = F.struct("weight", (-F.col("id")).alias("minus"), "id")
    centers = buckets.join(weight, "id").groupBy("key").agg(F.max(rank).alias("center"))
    centers = saved.write(centers.select("key", F.col("center.id").alias("v")), "centers")
    pairs = buckets.join(centers, "key").where("id <> v")
    return pairs.select(F.col("id").alias("u"), "v").distinct()


def inner_buckets(family: DataFrame, groups: DataFrame, saved: Saved) -> DataFrame:
    """(key, size, v, id, linked, component): members of a family that share an element of
    their prefixes, where they are in different groups."""
    apart = saved.write(family.where("not linked").select("v").distinct(), "apart")
    members = family.join(apart, "v").select(
        "v", F.col("u").alias("id"), "linked", F.explode("prefix").alias("element")
    )
    members = members.withColumn("key", F.xxhash64("v", "element")).drop("element")
    placed = members.join(groups, "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    placed = saved.write(placed, "placed")
    mixed = placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size")
    )
    mixed = saved.write(mixed.where("low < high").select("key", "size"), "mixed")
    return placed.join(mixed, "key")


def small_pairs(buckets: DataFrame) -> DataFrame:
    """(u, v): members of different groups in the same bucket of SMALL members at most."""
    small = buckets.where(F.col("size") <= SMALL)
    one = small.select("key", F.col("id").alias("u"), F.col("component").alias("cu"))
    two = small.select("key", F.col("id").alias("v"), F.col("component").alias("cv"))
    pairs = one.join(two, "key").where("u < v and cu <> cv")
    return pairs.select("u", "v").distinct()


def _block_links(key: tuple, table: pa.Table) -> pa.Table:
    """Links between strays and members of different groups in one block."""
    stray = table.column("stray").to_numpy()
    ids = table.column("id").to_numpy()
    component = table.column("component").to_numpy()
    sets = [np.frombuffer(e.as_buffer(), np.uint64) for e in table.column("elements")]
    members = np.flatnonzero(~stray)
    u, v = [], []
    if len(members):
        sizes = np.array([len(sets[m]) for m in members])
        elements = np.concatenate([sets[m] for m in members])
        order = np.argsort(elements)
        elements, owner = elements[order], np.repeat(np.arange(len(members)), sizes)[order]
        for x in np.flatnonzero(stray):
            low = np.searchsorted(elements, sets[x], "left")
            count = np.searchsorted(elements, sets[x], "right") - low
            at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            both = np.bincount(owner[at], minlength=len(members))
            linked = 100 * both >= PERCENT * (sizes + len(sets[x]) - both)
            for m in members[linked & (component[members] != component[x])]:
                u.append(ids[x])
                v.append(ids[m])
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def block_links(buckets: DataFrame, sets: DataFrame, saved: Saved) -> DataFrame:
    """(u, v): links of the strays in buckets of more than SMALL members with the members
    of the same family in such buckets."""
    active = buckets.where(F.col("size") > SMALL)
    active = active.groupBy("v", "id").agg(
        F.max("component").alias("component"), F.min("linked").alias("linked")
    )
    active = saved.write(active, "active")
    number = lambda rows: F.ceil(rows / BLOCK).cast("int")
    counts = active.groupBy("v").agg(
        number(F.count(F.when(~F.col("linked"), 1))).alias("strays"),
        number(F.count(F.lit(1))).alias("members"),
    )
    counts = saved.write(counts, "counts")
    dealt = active.join(counts, "v").join(sets, "id")
    own = lambda blocks: F.pmod(F.xxhash64("id"), F.col(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    columns = ["v", "i", "j", "stray", "id", "component", "elements"]
    strays = dealt.where(~F.col("linked")).withColumn("i", own("strays")).withColumn("j", every("members"))
    members = dealt.where("strays > 0").withColumn("j", own("members")).withColumn("i", every("strays"))
    rows = strays.withColumn("stray", F.lit(True)).select(*columns).unionByName(
        members.withColumn("stray", F.lit(False)).select(*columns)
    )
    return rows.groupBy("v", "i", "j").applyInArrow(_block_links, "u long, v long")


def direct_pairs(family: DataFrame, groups: DataFrame) -> DataFrame:
    """(u, v): members of one family, at least one of them not linked to the center, of
    which what they share with the center could be enough for a link.

    That takes a partner smaller than the center: x reaches partners of up to
    floor(175 |x n c| / 75) - |x| elements, and of no less than PERCENT of its own. They
    are met by the class of their size.
    """
    in_class = lambda size: F.floor(F.log(size.cast("double")) / F.lit(float(np.log(SIZE_STEP)))).cast("int")
    reach = F.floor(F.col("shared") * (100 + PERCENT) / PERCENT) - F.col("size")
    sized = family.select("v", "u", "linked", "size", "other", reach.cast("long").alias("reach"))
    sized = sized.join(groups.withColumnRenamed("id", "u"), "u", "left").withColumn(
        "component", F.coalesce("component", "u")
    )
    least = F.ceil(F.col("size") * PERCENT / 100).cast("long")
    most = F.least("reach", F.col("other") - 1)
    x = (
        sized.where(~F.col("linked") & (least <= most))
        .withColumn("class", F.explode(F.sequence(in_class(least) - 1, in_class(most) + 1)))
        .select("v", "class", F.struct("u", "size", "reach", "component").alias("x"))
    )
    y = sized.where("size < other").select(
        "v", in_class(F.col("size")).alias("class"), F.struct("u", "size", "reach", "component").alias("y")
    )
    return (
        x.join(y, ["v", "class"])
        .where(
            "y.size <= x.reach and x.size <= y.reach and x.component <> y.component"
            f" and 100 * least(x.size, y.size) >= {PERCENT} * greatest(x.size, y.size)"
        )
        .select(F.least("x.u", "y.u").alias("u"), F.greatest("x.u", "y.u").alias("v"))
        .distinct()
    )


def components(links: DataFrame, saved: Saved) -> DataFrame:
    """(id, component) of every id in ``links`` (u, v): the least id that it can reach.

    Union-find by rounds over tables: each tree is hooked to the least tree next to it,
    then every id jumps to its tree's tree, until a round changes nothing.
    """
    edges = saved.write(
        links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))),
        "edges",
    )
    roots = edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("m"))
    roots = roots.select("id", F.least("id", "m").alias("component"))
    roots, total = saved.write(roots, "roots"), None
    while True:
        jump = roots.select(F.col("id").alias("via"), F.col("component").alias("beyond"))
        # The least tree next to each tree, by all edges that leave the tree's ids.
        near = (
            edges.join(jump, F.col("v") == F.col("via"))
            .select("u", F.col("beyond").alias("near"))
            .groupBy("u")
            .agg(F.min("near").alias("near"))
        )
        hooked = roots.join(near, F.col("id") == F.col("u"), "left").select(
            "id", "component", F.least("component", "near").alias("least")
        )
        hooks = hooked.groupBy(F.col("component").alias("tree")).agg(F.min("least").alias("to"))
        hooks = saved.write(hooks, "hooks")
        grown = roots.join(hooks, F.col("component") == F.col("tree")).select("id", "to")
        jumped = (
            grown.join(
                hooks.select(F.col("tree").alias("t2"), F.col("to").alias("to2")),
                F.col("to") == F.col("t2"),
                "left",
            )
            .select("id", F.coalesce("to2", "to").alias("component"))
        )
        new = saved.write(jumped, "roots")
        now = new.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        saved.drop([roots, hooks])
        if now == total:
            saved.drop([edges])
            return new
        roots, total = new, now


def several(rows: DataFrame) -> DataFrame:
    """(doc_id): those whose rows have different sets."""
    ends = [f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("hi", "lo")]
    found = rows.where("doc_id is not null").groupBy("doc_id").agg(*ends)
    return found.where("min_hi <> max_hi or min_lo <> max_lo").select("doc_id")


def same_document(repeated: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(u, v): the least class of each doc_id in ``repeated`` with its others."""
    own = rows.where("n_shingles > 0").join(repeated, "doc_id").select("doc_id", "hi", "lo").distinct()
    own = own.join(classes.select("hi", "lo", "id"), ["hi", "lo"]).select("doc_id", "id").distinct()
    least = own.groupBy("doc_id").agg(F.min("id").alias("u"))
    return own.join(least, "doc_id").where("id <> u").select("u", F.col("id").alias("v")).distinct()


def grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    The component is the least doc_id of the document's group; ``kept`` marks that
    document. Texts without words, null ones included, are groups of their own. Rows that
    repeat a doc_id are one document: links of each of their texts count for all, and texts
    without words are in the group of the others. A row without a doc_id is linked with
    nothing: its component is null, and it is kept.
    """
    spark = docs.sparkSession
    saved = Saved(spark, "near")
    rows = saved.write(signed(docs), "signed")
    classes = saved.write(
        rows.where("n_shingles > 0 and doc_id is not null")
        .groupBy("hi", "lo")
        .agg(
            F.min("doc_id").alias("id"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    keyed = classes.select("id", F.explode("bands").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = saved.write(sizes, "sizes")
    buckets = saved.write(keyed.join(sizes, "key").select("key", "size", "id"), "buckets")
    sets = saved.write(full_sets(docs, classes, buckets.select("id").distinct()), "sets")
    pairs = saved.write(families(buckets, saved), "pairs")
    family = saved.write(compared(pairs, sets), "family")
    links = family.where("linked").select("u", "v")
    repeated = saved.write(several(rows), "repeated")
    if some := not repeated.isEmpty():
        links = links.unionByName(same_document(repeated, rows, classes))
    links = saved.write(links, "links")
    groups = components(links, saved)
    inner = saved.write(inner_buckets(family, groups, saved), "inner")
    pairs = direct_pairs(family, groups).unionByName(small_pairs(inner)).distinct()
    more = compared(saved.write(pairs, "pairs"), sets).where("linked").select("u", "v")
    more = saved.write(more.unionByName(block_links(inner, sets, saved)), "more")
    if not more.isEmpty():
        groups = components(links.unionByName(more), saved)
    found = saved.write(
        classes.select("hi", "lo", "id")
        .join(groups, "id", "left")
        .select("hi", "lo", F.coalesce("component", "id").alias("component_id")),
        "found",
    )
    kept = [rows, found]
    out = rows.select("doc_id", "n_shingles", "hi", "lo").join(found, ["hi", "lo"], "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    other = F.col("doc_id")
    if some:
        own = rows.where("n_shingles > 0").join(repeated, "doc_id").join(found, ["hi", "lo"])
        own = own.groupBy("doc_id").agg(F.min("component_id").alias("own"))
        kept.append(saved.write(own, "own"))
        out = out.join(kept[-1], "doc_id", "left")
        other = F.coalesce("own", "doc_id")
    saved.keep(kept)
    component = F.when(linked, F.col("component_id")).otherwise(other)
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, that with the least doc_id, and all columns.

    Rows that repeat a doc_id are one document, of which the row with the least text hash
    stays. Rows without a doc_id are linked with nothing and stay.
    """
    spark = docs.sparkSession
    saved = Saved(spark, "near-dedup")
    found = saved.write(grouped(docs.select("doc_id", "text")), "groups")
    kept = found.where("kept and doc_id is not null").select("doc_id").distinct()
    by_id = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    named = docs.where("doc_id is not null").withColumn("__nth", F.row_number().over(by_id))
    named = named.where("__nth = 1").join(kept, "doc_id", "left_semi")
    return named.select(*docs.columns).unionByName(docs.where("doc_id is null"))
