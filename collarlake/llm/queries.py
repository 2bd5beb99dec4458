"""The operators as queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from collarlake.llm import (
    balltree,
    bpe,
    graph,
    linededup,
    lm,
    merkle,
    mixing,
    neardup,
    packing,
    quality,
    runs,
    sharding,
    tokencounts,
)
from collarlake.llm.tables import Saved, read
from collarlake.workspace import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def tokenizer(name: str) -> str:
    """Where the public tokenizer files are installed, on every machine alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("byte_bpe_50k.json")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, path, keep_text=False)
    return bpe.decode(encoded, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query(
    "op2_line_dedup",
    """
    with split as (
        select doc_id, string_split(text, chr(10)) as lines from documents),
    spread as (
        select doc_id, lines, unnest(range(0, len(lines) - 2)) as pos from split),
    windows as (
        select doc_id, pos, lines[pos + 1:pos + 3] as three from spread
        where trim(array_to_string(lines[pos + 1:pos + 3], '')) <> ''),
    ranked as (
        select doc_id, pos, row_number() over (partition by three order by doc_id, pos) as nth
        from windows),
    covered as (
        select doc_id, list(distinct pos + o) as gone
        from ranked, (select unnest([0, 1, 2]) as o) where nth > 1 group by doc_id)
    select doc_id,
           cast(len(lines) as bigint) as n_lines,
           cast(coalesce(len(gone), 0) as bigint) as n_removed,
           array_to_string(
               [lines[i + 1] for i in range(0, len(lines))
                if not list_contains(coalesce(gone, []), i)], chr(10)) as text
    from split left join covered using (doc_id)
    """,
)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    n_lines = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long")
    after = linededup.dedup_lines(docs.withColumn("n_lines", n_lines), count="n_removed")
    return after.select("doc_id", "n_lines", "n_removed", "text")


@query("op3_near_dedup")
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.grouped(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_sharding")
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
    )
    return sharding.assign(rows, shards=16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def bucket(divisor: int) -> Column:
    """The remainder by which rows are kept from learning."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(divisor))


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    saved = Saved(spark, "quality")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    x = saved.write(quality.featurised(docs), "features")
    model = quality.fit(x, quality.trusted(labels, bucket(4) != 2), saved)
    return quality.scored(x, model).select(
        "doc_id",
        F.coalesce(bucket(4) == 2, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@query(
    "op6_top_k",
    """
    with points as (
        select vec_id, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as v
        from embeddings
        where len(embedding) > 0
          and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
    scored as (
        select q.vec_id as query_id, p.vec_id,
               cast(list_sum([q.v[i] * p.v[i] for i in range(1, len(q.v) + 1)]) as bigint) as score
        from points q join points p on q.vec_id <> p.vec_id and len(q.v) = len(p.v)
        where q.vec_id % 50 = 0)
    select query_id,
           cast(row_number() over (partition by query_id order by score desc, vec_id) as integer)
               as rank,
           vec_id, score
    from scored
    qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5
    """,
)
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return balltree.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


@query("op7_lm")
def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(bucket(5) == 1, F.lit(False))
    model = lm.train(docs.where(~held_out), scratch_dir(spark, "language-model"), order=3)
    docs = docs.select("doc_id", held_out.alias("held_out"), "text")
    return lm.score(docs, model).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query("op8_nearest")
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return graph.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


@query("op9_mixing")
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.rated(docs).select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__size") * F.col("__copies")).alias("taken"),
    )


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text"
    )
    # A cache of its own, so that a run does not depend on those before it. It is begun with
    # half of the documents, as an earlier run would have left it; then all are counted,
    # and only contents that are not in it yet are encoded.
    cache, path = scratch_dir(spark, "token-counts"), tokenizer("word_bpe_49k.json")
    tokencounts.counted(docs.where(bucket(2) == 0), path, cache)
    return tokencounts.counted(docs, path, cache).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit")
    )


# The parity of crc32 of a number's decimal digits, which SQL has no function for.
CRC32 = """
    xor(4294967295, list_reduce(
        list_prepend(cast(4294967295 as bigint),
                     [cast(ascii(c) as bigint) for c in string_split(cast(doc_id as varchar), '')]),
        lambda crc, byte: list_reduce(
            [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, _: xor(x >> 1, case when x & 1 = 1 then 3988292384 else 0 end))))
"""


def _sql_digest(*fields: str) -> str:
    parts = (f"coalesce(strlen(cast({f} as varchar)) || ':' || cast({f} as varchar), '-')" for f in fields)
    return "sha256(" + " || ".join(parts) + ")"


def _sql_tree(name: str, leaves: str) -> str:
    """Levels of the trees over ``leaves``, which has grp, pos, n and node."""
    return f"""{name} as (
        select 0 as lvl, grp, pos, n, node from {leaves}
        union all
        select lvl + 1, grp, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' order by pos))
        from {name} where n > 1 group by lvl, grp, n, pos // 3)"""


@query(
    "op11_manifest",
    f"""
    with recursive rows_ as materialized (
        select row_number() over () as id, doc_id, source as grp,
               {_sql_digest("doc_id", "source", "lang", "n_chars", "text")} as node,
               case when {CRC32} % 2 = 0
                    then {_sql_digest("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')")}
                    else {_sql_digest("doc_id", "source", "lang", "n_chars", "text")} end as own
        from documents),
    leaves as materialized (
        select *, row_number() over (partition by grp order by doc_id nulls first, node) - 1 as pos,
               count(*) over (partition by grp) as n from rows_),
    {_sql_tree("low", "leaves")},
    tops as materialized (
        select 0 as grp, row_number() over (order by grp nulls first) - 1 as pos,
               count(*) over () as n, node, grp as name from low where n = 1),
    {_sql_tree("high", "tops")},
    steps as (
        select 0 as part, id, lvl, low.pos - low.pos % 3 as first, low.pos, low.node, low.n,
               leaves.pos // cast(pow(3, lvl) as bigint) as mine
        from leaves join low on low.grp is not distinct from leaves.grp
             and low.pos // 3 = leaves.pos // cast(pow(3, lvl + 1) as bigint) and low.n > 1
        union all
        select 1, id, lvl, high.pos - high.pos % 3, high.pos, high.node, high.n,
               tops.pos // cast(pow(3, lvl) as bigint)
        from leaves join tops on tops.name is not distinct from leaves.grp
             join high on high.pos // 3 = tops.pos // cast(pow(3, lvl + 1) as bigint) and high.n > 1),
    siblings as (
        select id, part, lvl,
               coalesce(string_agg(node, '' order by pos) filter (pos < mine), '') as before,
               coalesce(string_agg(node, '' order by pos) filter (pos > mine), '') as after
        from steps group by all),
    climb as materialized (
        select *, row_number() over (partition by id order by part, lvl) as step from siblings),
    folded as (
        select id, 0 as step, own as node from leaves
        union all
        select f.id, c.step, sha256(c.before || f.node || c.after)
        from folded f join climb c on c.id = f.id and c.step = f.step + 1),
    ends as (select id, arg_max(node, step) as node from folded group by id),
    proofs as (select id, string_agg(before || after, '' order by part, lvl) as proof from siblings group by id),
    root as (select node from high where n = 1)
    select leaves.doc_id, leaves.node as leaf, tops.node as subroot, root.node as root,
           sha256(coalesce(proof, '')) as proof_sha256, ends.node as folded_root,
           ends.node = root.node as verified
    from leaves join ends using (id) join tops on tops.name is not distinct from leaves.grp
         cross join root left join proofs using (id)
    """,
)
def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    text = F.col("text")
    tampered = F.when(bucket(2) == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    made = merkle.manifest(
        docs, "source", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], {"text": tampered}
    )

    def shown(name: str) -> Column:
        return F.lower(F.hex(name))

    return made.select(
        "doc_id",
        shown("leaf").alias("leaf"),
        shown("subroot").alias("subroot"),
        shown("root").alias("root"),
        F.sha2(shown("proof"), 256).alias("proof_sha256"),
        shown("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def looped(text: Column, doc_id: str) -> Column:
    """A tenth of the texts, with words from some place on that repeat with a period."""
    h = F.crc32(F.col(doc_id).cast("string"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = F.pmod(g, F.greatest(n, F.lit(1)))
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    period = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    tail = F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int")))
    tail = F.slice(tail, F.lit(1), (n - a).cast("int"))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")
    return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), made).otherwise(text)


@query("op12_runs")
def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.detect(docs.select("doc_id", looped(F.col("text"), "doc_id").alias("text")))
    # The longest one; of equal ones the first, then that of the least period.
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    )
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias(
            "runs_sha256"
        ),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_packing")
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), "doc_id", capacity=2048, end=0)
