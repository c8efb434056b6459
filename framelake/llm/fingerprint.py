"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

Terms are a text's words, their weights how often they occur. For each of the samples a term has two
Gamma(2, 1) variables r and c and a uniform b, from hashes of the term; with t = floor(ln w / r + b) its
value is ln c - r (t - b + 1), and the least value over the terms is the sample. A value is a function
of term, sample and t alone, so two texts agree in a sample as often as generalised Jaccard similarity,
sum of minima over sum of maxima of the weights, says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import work

WORD_BREAK = "[\\\\x20\\\\x09-\\\\x0D]+"
TRAILING = "^[^\\\\x20\\\\x09-\\\\x0D]*"
#: Samples that one pass over the terms computes; more make code that the JVM won't compile.
AT_ONCE = 8


def _samples(term: str, group: str, weights: list[str]) -> list[Column]:
    """AT_ONCE least values for each column of weights' logarithms: a row per group of samples goes in."""
    out = []
    for j in range(AT_ONCE):
        h1 = f"xxhash64({term}, {group}, {j})"
        h2 = f"xxhash64({term}, {group}, {j + AT_ONCE})"
        u = lambda h, s: f"((shiftright({h}, {s}) & 33554431) + 0.5D)"
        r = f"(34.657359027997264D - ln({u(h1, 0)} * {u(h1, 25)}))"  # 50 ln 2 - ln(product of 25-bit uniforms)
        c = f"ln(34.657359027997264D - ln({u(h2, 0)} * {u(h2, 25)}))"
        b = f"((shiftrightunsigned({h1}, 50) * 16384D + shiftrightunsigned({h2}, 50)) / 268435456D)"
        for w in weights:
            out.append(F.expr(f"min({c} - {r} * (floor({w} / {r} + {b}) - {b} + 1D))").alias(f"{w}_{j}"))
    return out


def _signatures(terms: DataFrame, keys: list[str], weights: list[str], samples: int, rest: list[Column]) -> DataFrame:
    """keys, an array of `samples` integers for each weight column (empty without terms), and `rest`.

    `terms`: keys, term, and a weight column for each text. If it is partitioned by the keys, so is the
    result, without a shuffle.
    """
    if samples <= 0 or samples % AT_ONCE:
        raise ValueError(f"samples must be a positive multiple of {AT_ONCE}")
    groups = samples // AT_ONCE
    logs = terms.withColumns({w: F.expr(f"case when {w} > 0 then ln({w}) end") for w in weights})
    spread = logs.withColumn("cws__group", F.explode(F.array(*[F.lit(i) for i in range(groups)])))
    least = spread.groupBy(*keys, "cws__group").agg(*_samples("term", "cws__group", weights), *rest)
    tokens = [F.expr("array(" + ", ".join(f"cast(xxhash64({w}_{j}) & 2147483647 as int)" for j in range(AT_ONCE)) + ")").alias(w) for w in weights]
    some = [F.col(f"{w}_0").isNotNull().alias(f"{w}_some") for w in weights]
    names = [c for c in least.columns if c not in (*keys, "cws__group") and not any(c == f"{w}_{j}" for w in weights for j in range(AT_ONCE))]
    parts = least.select(*keys, F.struct("cws__group", *tokens).alias("cws__part"), *some, *names)
    gathered = parts.groupBy(*keys).agg(
        F.array_sort(F.collect_list("cws__part")).alias("cws__parts"), *[F.max(f"{w}_some").alias(f"{w}_some") for w in weights], *[F.max(n).alias(n) for n in names]
    )
    return gathered.select(*keys, *[F.when(F.col(f"{w}_some"), F.flatten(F.col(f"cws__parts.{w}"))).otherwise(F.array().cast("array<int>")).alias(w) for w in weights], *names)


def likeness(a: str, b: str) -> Column:
    """Share of samples in which two signatures agree: 1 for two without words, 0 for one."""
    return F.expr(
        f"case when size({a}) = 0 or size({b}) = 0 then case when size({a}) = size({b}) then 1.0D else 0.0D end "
        f"else aggregate(zip_with({a}, {b}, (x, y) -> if(x = y, 1, 0)), 0, (s, x) -> s + x) / cast(size({a}) as double) end"
    )


def as_text(a: str) -> Column:
    return F.expr(f"array_join(transform({a}, x -> lower(lpad(hex(x), 8, '0'))), '')")


def signatures(df: DataFrame, key: list[str], text: str = "text", samples: int = 64) -> DataFrame:
    """key and signature of each row's whole text; null texts have no words, rows alike in `key` count as one text."""
    words = df.select(*key, F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+")).alias("word"))
    terms = words.withColumn("term", F.xxhash64("word")).groupBy(*key, "term").agg(F.sum(F.expr("if(word = '', 0, 1)")).alias("signature"))
    return _signatures(terms, key, ["signature"], samples, [])


def edited_fingerprints(documents: DataFrame, samples: int = 64) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with likenesses.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many of the next
    document, ascending doc_id, nulls first; after the last comes the first. Documents alike in doc_id
    are ordered by their texts' SHA-256; rows alike in both are one document, returned as often.
    Null texts are empty. Texts are shuffled once, by document, with the pieces that documents lend
    to their predecessors; words are counted and sampled where the texts lie.
    """
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tid", F.sha2(F.col("text").cast("binary"), 256))
    keyed = texts.withColumns({"k1": F.xxhash64("doc_id", "tid", F.lit(1)), "k2": F.xxhash64("tid", "doc_id", F.lit(2))})
    names = keyed.groupBy("doc_id", "tid", "k1", "k2").agg(F.max(F.char_length("text")).cast("long").alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    numbered, total = work.with_row_numbers(names, ["doc_id", "tid"], "rn")
    lender = numbered.select(((F.col("rn") + (total - 1)) % max(total, 1)).alias("rn"), F.col("k1").alias("next_k1"), F.col("k2").alias("next_k2"), F.col("doc_id").alias("next_doc"))
    links = work.materialize(numbered.join(lender, "rn"), "links")
    work.release(numbered)
    borrows = links.select(F.col("next_k1").alias("k1"), F.col("next_k2").alias("k2"), F.col("k1").alias("to_k1"), F.col("k2").alias("to_k2"), F.expr("n_chars div 4").alias("lend"))

    once = keyed.select("k1", "k2", "text").withColumn("copy", F.expr("row_number() over (partition by k1, k2 order by 1)")).where("copy = 1").drop("copy")
    pieces = once.join(borrows, ["k1", "k2"]).selectExpr("to_k1 as k1", "to_k2 as k2", "substring(text, 1, cast(lend as int)) as piece")
    both = (
        once.join(pieces, ["k1", "k2"])
        .withColumn("n_chars", F.char_length("text"))
        .withColumn("head", F.expr("substring(text, 1, n_chars - n_chars div 4)"))
        .withColumn("edited", F.expr("concat(head, piece)"))
        .withColumn("common", F.expr(f"char_length(head) - char_length(regexp_extract(reverse(head), '{TRAILING}', 0))"))
        .withColumn("sha", F.sha2(F.col("edited").cast("binary"), 256))
    )
    long = lambda i: f"cast(conv(substring(sha, {16 * i + 1}, 16), 16, -10) as bigint)"
    # three pieces of text: of both, of the original, of the edited one; four rows carry the edited text's digest
    rows = both.select(
        "k1",
        "k2",
        F.expr(
            "stack(7, substring(text, 1, common), 1L, 1L, 0, substring(text, common + 1), 1L, 0L, 0, substring(edited, common + 1), 0L, 1L, 0, "
            + ", ".join(f"'', {long(i)}, 0L, {i + 1}" for i in range(4))
            + ") as (part, a, b, tag)"
        ),
    )
    words = rows.select("k1", "k2", "a", "b", "tag", F.expr(f"explode(split(part, '{WORD_BREAK}')) as word")).where("word <> '' or tag > 0")
    # hashes of words keep clear of the four tags
    counted = words.selectExpr("k1", "k2", "if(tag > 0, cast(tag as bigint), shiftleft(xxhash64(word), 3)) as term", "a", "b").groupBy("k1", "k2", "term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    weighed = counted.withColumns({f"s{i}": F.expr(f"case when term = {i + 1} then a end") for i in range(4)})
    weighed = weighed.selectExpr("k1", "k2", "term", "if(term between 1 and 4, 0L, a) as fp", "if(term between 1 and 4, 0L, b) as efp", *[f"s{i}" for i in range(4)])
    carried = [F.max(f"s{i}").alias(f"s{i}") for i in range(4)]
    made = work.materialize(_signatures(weighed, ["k1", "k2"], ["fp", "efp"], samples, carried), "signatures")

    following = links.select("k1", "k2", "next_k1", "next_k2").join(made.select(F.col("k1").alias("next_k1"), F.col("k2").alias("next_k2"), F.col("fp").alias("nfp")), ["next_k1", "next_k2"]).select("k1", "k2", "nfp")
    return (
        made.join(links, ["k1", "k2"])
        .join(following, ["k1", "k2"])
        .withColumn("copy", F.explode(F.expr("sequence(1, copies)")))
        .select(
            "doc_id",
            "n_chars",
            F.expr("lower(concat(" + ", ".join(f"lpad(hex(s{i}), 16, '0')" for i in range(4)) + "))").alias("edited_sha256"),
            as_text("fp").alias("fingerprint"),
            as_text("efp").alias("edited_fingerprint"),
            likeness("fp", "efp").alias("near_edited"),
            likeness("fp", "nfp").alias("near_next"),
        )
    )
