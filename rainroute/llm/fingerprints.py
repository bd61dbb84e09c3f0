"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is its words with their counts as weights. For sample i and word k, hashes give
r and c of the Gamma(2, 1) distribution, each the negative logarithm of a product of two uniform
numbers, and b of the uniform one. With weight S:

    t = floor(ln S / r + b)        ln a = ln c - r * (t - b + 1)

The word with the smallest a, and its t, are sample i of the text. Two texts agree in a
sample with probability sum(min weights) / sum(max weights): the share of
equal samples estimates their generalised Jaccard similarity. (k, t) is kept as 24 bits.

Texts are dealt out once, by ranges of ids; counting words and taking minima then need
no further shuffle. Minima are over 64-bit numbers, so nothing of a text is sorted or collected.

Most words cannot hold the minimum, which shows before any logarithm: with c = -ln U and r = -ln V,
a >= c * exp(-r) / S >= (1 - U) * V / S. Words above NEAR / (number of words) are left out; a minimum below that is
the minimum of all words. Should one not be below (one sample in exp(NEAR)), all is computed again from all words.

Defined cases: a null text is empty; an empty text has the empty word once, so empty
texts are alike and unlike others; rows of one id stand in the order of their texts; null ids come
last; the only document is its own next; an empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rainroute.session import materialise

SAMPLES = 64
AT_ONCE = 4  # samples computed in one pass over a word's row
NEAR = 30.0  # the sum of a text's weights times its smallest a exceeds this once in exp(30) samples
_NONE = (1 << 62) - 1  # larger than any sample
SPLIT = "[ \\n\\t\\r]+"


def _uniform(hash_: str, shift: int, bits: int) -> str:
    """Bits of a hash as a number above 0 and below 1."""
    return f"((shiftrightunsigned({hash_}, {shift}) & {(1 << bits) - 1}) + 0.5D) / {1 << bits}D"


def _product(hash_: str) -> str:
    """A product of two uniform numbers from the upper 42 bits of a hash."""
    return f"{_uniform(hash_, 43, 21)} * {_uniform(hash_, 22, 21)}"


def _gamma(hash_: str) -> str:
    """A number of the Gamma(2, 1) distribution from the upper 42 bits of a hash."""
    return f"-ln({_product(hash_)})"


def _sample(i: int, weight: str) -> str:
    """Sample i of a word, given the logarithm of its weight, as a number whose order is that of a."""
    t = f"floor({weight} / r{i} + b{i})"
    ln_a = f"(c{i} - r{i} * ({t} - b{i} + 1))"
    return f"cast({ln_a} * 1073741824D as bigint) * 16777216 + ((k{i} ^ ({t} * 10368889)) & 16777215)"


def signatures(bodies: DataFrame, keys: list[str], kinds: int, at_once: int = AT_ONCE, near: float = math.inf) -> DataFrame:
    """Samples ``f0``, ... of each kind of text of a key, as hexadecimal digits, and ``sure``.

    ``bodies``: keys, ``kind`` (0 to kinds - 1) and ``body``. ``at_once`` samples are computed in one pass
    over a word's row, of which there are SAMPLES / at_once; the result is the same for any. Samples are those of
    the words that ``near`` leaves in (inf: all); where ``sure``, they are those of all words.
    """
    lists = bodies.select(*keys, "kind", F.split("body", SPLIT.replace("\\\\", "\\")).alias("words"))
    words = lists.select(*keys, "kind", F.size("words").alias("z"), F.explode("words").alias("w"))
    counts = words.groupBy(*keys, F.xxhash64("w").alias("w")).agg(
        *[F.sum(F.when(F.col("kind") == k, 1).otherwise(0)).alias(f"n{k}") for k in range(kinds)],
        *[F.max(F.when(F.col("kind") == k, F.col("z"))).alias(f"z{k}") for k in range(kinds)],
    )
    bound = "double('inf')" if math.isinf(near) else f"{near!r}D"
    # Few samples at a time keep the generated code small enough for the JVM to compile well.
    parts = counts.select(
        *keys,
        "w",
        # -1 marks a kind of text without the word.
        *[F.expr(f"if(n{k} > 0, ln(n{k}), -1D)").alias(f"s{k}") for k in range(kinds)],
        *[f"z{k}" for k in range(kinds)],
        F.greatest(F.lit(0.0), *[F.expr(f"if(n{k} > 0, n{k} * {bound} / z{k}, 0D)") for k in range(kinds)]).alias("most"),
        F.explode(F.sequence(F.lit(0), F.lit(SAMPLES // at_once - 1))).alias("g"),
    )
    texts = [f"{c}{k}" for c in "sz" for k in range(kinds)]
    hashes = parts.select(
        *keys,
        "g",
        *texts,
        "most",
        *[F.xxhash64("w", F.col("g") * at_once + i, F.lit(0)).alias(f"h{i}") for i in range(at_once)],
        *[F.xxhash64("w", F.col("g") * at_once + i, F.lit(1)).alias(f"k{i}") for i in range(at_once)],
    )
    products = hashes.select(
        *keys,
        "g",
        *texts,
        "most",
        *[f"k{i}" for i in range(at_once)],
        *[F.expr(_uniform(f"h{i}", 0, 22)).alias(f"b{i}") for i in range(at_once)],
        *[F.expr(_product(f"h{i}")).alias(f"v{i}") for i in range(at_once)],
        *[F.expr(_product(f"k{i}")).alias(f"u{i}") for i in range(at_once)],
    )
    # NULL marks a sample that is left out.
    logs = products.select(
        *keys,
        "g",
        *texts,
        *[f"k{i}" for i in range(at_once)],
        *[f"b{i}" for i in range(at_once)],
        *[F.expr(f"if((1 - u{i}) * v{i} <= most, -ln(v{i}), null)").alias(f"r{i}") for i in range(at_once)],
        *[F.expr(f"if((1 - u{i}) * v{i} <= most, ln(-ln(u{i})), null)").alias(f"c{i}") for i in range(at_once)],
    )
    least = logs.groupBy(*keys, "g").agg(
        *[F.max(f"z{k}").alias(f"z{k}") for k in range(kinds)],
        *[
            F.expr(f"min(if(s{k} >= 0 and r{i} is not null, {_sample(i, f's{k}')}, {_NONE}))").alias(f"m{k}_{i}")
            for k in range(kinds)
            for i in range(at_once)
        ],
    )
    # The bound in the order of samples, less a margin for rounding.
    sure = " and ".join(
        f"greatest({', '.join(f'm{k}_{i}' for i in range(at_once))}) < "
        f"cast((ln({near!r}D / z{k}) - 1e-6D) * 1073741824D as bigint) * 16777216"
        for k in range(kinds)
    )
    least = least.withColumn("sure", F.lit(True) if math.isinf(near) else F.coalesce(F.expr(sure), F.lit(False)))
    digits = [
        F.concat(*[F.lpad(F.hex(F.expr(f"m{k}_{i} & 16777215")), 6, "0") for i in range(at_once)]).alias(f"f{k}")
        for k in range(kinds)
    ]
    # The rows of a key, put side by side.
    rows = least.select(*keys, "sure", F.struct("g", *digits).alias("d"))
    whole = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("d")).alias("d"), F.every("sure").alias("sure"))
    return whole.select(*keys, "sure", *[F.expr(f"array_join(d.f{k}, '')").alias(f"f{k}") for k in range(kinds)])


def likeness(a: str, b: str) -> Column:
    """Share of equal samples of two fingerprints."""
    same = f"filter(sequence(0, {SAMPLES - 1}), i -> substring({a}, 6 * i + 1, 6) = substring({b}, 6 * i + 1, 6))"
    return F.expr(f"size({same}) / {SAMPLES}D")


def _ranges(docs: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``part``, numbered as ids fall, and for each part the next one's first document (``head``)."""
    spark = docs.sparkSession
    shares = ", ".join(f"{i / parts:.6f}D" for i in range(1, parts))
    bounds = docs.agg(F.expr(f"approx_percentile(doc_id, array({shares}), {max(10_000, 10 * parts)})").alias("b")).first().b
    bounds = sorted(set(bounds or []))
    if bounds:  # few numbers: one per part
        listed = ", ".join(f"{b}L" for b in bounds)
        part = F.expr(f"if(doc_id is null, {len(bounds) + 1}, size(filter(array({listed}), x -> x >= doc_id)))")
    else:
        part = F.lit(0)
    docs = docs.withColumn("part", part)
    tops = docs.groupBy("part").agg(F.max("doc_id").alias("doc_id")).orderBy("part").collect()
    links = [(r.part, s.part, s.doc_id) for r, s in zip(tops, [*tops[1:], *tops[:1]], strict=True)]
    link = spark.createDataFrame(links, "part int, next_part int, doc_id long")
    first = docs.join(
        F.broadcast(link.select(F.col("next_part").alias("p"), F.col("doc_id").alias("d"))),  # a row per part
        (F.col("part") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("d")),
    )
    texts = first.groupBy("part").agg(F.min("text").alias("head"))
    heads = texts.join(signatures(texts.select("part", F.lit(0).alias("kind"), F.col("head").alias("body")), ["part"], 1, SAMPLES), "part")
    heads = materialise(heads.select(F.col("part").alias("next_part"), "head", F.col("f0").alias("head_print")), "heads")
    return docs, materialise(link.drop("doc_id").join(heads, "next_part").drop("next_part"), "nexts")


def fingerprints(docs: DataFrame, near: float = NEAR) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row.

    The edited text has its last third replaced by the beginning of the next
    document, in the order of falling ids. The result is the same for any ``near``.
    """
    found = materialise(_fingerprints(docs, near), "prints")
    if not found.where("not sure").isEmpty():
        found = _fingerprints(docs, math.inf)
    return found.drop("sure")


def _fingerprints(docs: DataFrame, near: float) -> DataFrame:
    """The columns of ``fingerprints``, and whether both of a row's fingerprints are ``sure``."""
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows, nexts = _ranges(rows, parts)
    fall = Window.partitionBy("part").orderBy(F.desc_nulls_last("doc_id"), "text")
    placed = (
        rows.repartition(parts, "part")
        .withColumn("place", F.row_number().over(fall))
        .withColumn("following", F.lead("text").over(fall))
        .join(nexts.select("part", "head"), "part")
        .withColumn("following", F.coalesce("following", "head"))
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("third", F.expr("cast(n_chars div 3 as int)"))
        .withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars as int) - third), substring(following, 1, third))"))
        .select("part", "place", "doc_id", "n_chars", "text", "edited")
    )
    bodies = placed.select("part", "place", F.expr("stack(2, 0, text, 1, edited) as (kind, body)"))
    prints = signatures(bodies, ["part", "place"], 2, near=near)
    about = placed.select("part", "place", "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    by_place = Window.partitionBy("part").orderBy("place")
    return (
        about.join(prints, ["part", "place"])
        .withColumn("next_print", F.lead("f0").over(by_place))
        .join(nexts.select("part", "head_print"), "part")
        .withColumn("next_print", F.coalesce("next_print", "head_print"))
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            F.col("f0").alias("fingerprint"),
            F.col("f1").alias("edited_fingerprint"),
            likeness("f0", "f1").alias("near_edited"),
            likeness("f0", "next_print").alias("near_next"),
            "sure",
        )
    )


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text of ``documents`` and of its edited text."""
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
