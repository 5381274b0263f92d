"""Training samples: reading mixed records, rejecting, splitting; keyword coverage, keyword retrieval, prompts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_text, keywords, looks_like_navigation, normalize_keywords, rejection, section_label


def iter_texts(records: DataFrame) -> DataFrame:
    """(ordinal, pos, text, source_url, chunk_id, section_path) of records with any of text, body_text and chunks; nulls left out.

    Order within a record is text, body_text, then the chunks. ordinal is the records' own column.
    """
    null = F.lit(None)
    has = set(records.columns)
    field = lambda c, t: F.col(c).cast(t) if c in has else null.cast(t)
    one = lambda text, ident: F.struct(text.alias("text"), ident.cast("bigint").alias("chunk_id"))
    items = F.array(one(field("text", "string"), field("chunk_id", "bigint")), one(field("body_text", "string"), null))
    if "chunks" in has:
        items = F.concat(items, F.transform(F.coalesce("chunks", F.array().cast(records.schema["chunks"].dataType)), lambda c: one(c["text"], c["chunk_id"])))
    url = field("url", "string")
    if "metadata" in has:
        url = F.coalesce(url, F.col("metadata.url"))
    path = field("section_path", "string")
    return records.select("ordinal", url.alias("source_url"), path.alias("section_path"), F.posexplode(F.filter(items, lambda x: x["text"].isNotNull())).alias("pos", "item")).select("ordinal", "pos", "item.text", "source_url", "item.chunk_id", "section_path")


def judge_samples(samples: DataFrame, min_chars: int = 200, max_chars: int = 1600, include_keywords: Iterable[str] = (), navbox_filter: bool = False, text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """samples with their text cleaned and rejected, the reason why one is left out (null for those kept; null texts are below min_chars)."""
    cleaned = samples.withColumn(text_col, clean_text(F.coalesce(F.col(text_col), F.lit(""))))
    reason = rejection(F.col(text_col), min_chars, max_chars, include_keywords)
    if navbox_filter:
        path = F.col(path_col) if path_col else F.lit(None).cast("string")
        reason = F.when(looks_like_navigation(F.col(text_col), path), "navigation").otherwise(reason)
    return cleaned.withColumn("rejected", reason)


def first_accepted(judged: DataFrame, max_chunks: int, ordinal_col: str = "ordinal") -> DataFrame:
    """judged up to the max_chunks-th accepted row in order: scanning stops there, for coverage of required keywords as well."""
    last = judged.where("rejected is null").select(F.col(ordinal_col).alias("o")).orderBy("o").limit(max_chunks).agg(F.max("o").alias("last"), F.count("*").alias("n"))
    stop = F.broadcast(last)  # one row
    return judged.crossJoin(stop).where((F.col("n") < max_chunks) | (F.col(ordinal_col) <= F.col("last"))).drop("last", "n")


def keyword_coverage(judged: DataFrame, required: Iterable[str], text_col: str = "text", ordinal_col: str = "ordinal") -> DataFrame:
    """(keyword, seen, first_rejection): whether a kept sample holds the keyword, and why the first sample that holds it was left out."""
    names = F.explode(F.array(*(F.lit(k) for k in normalize_keywords(required)))).alias("keyword")
    flags = judged.select(ordinal_col, "rejected", F.lower(text_col).alias("lower"), names).where(F.col("lower").contains(F.col("keyword")))
    found = flags.groupBy("keyword").agg(F.bool_or(F.col("rejected").isNull()).alias("any_kept"), F.min_by("rejected", F.when(F.col("rejected").isNotNull(), F.col(ordinal_col))).alias("first_rejection"))
    spark = judged.sparkSession
    every = spark.createDataFrame([(k,) for k in normalize_keywords(required)], "keyword string")
    return every.join(found, "keyword", "left").select("keyword", F.coalesce("any_kept", F.lit(False)).alias("seen"), "first_rejection")


def train_eval_split(samples: DataFrame, ratio: float = 0.02, seed: int = 13, key_col: str = "doc_id") -> DataFrame:
    """samples with split: eval for the max(1, int(n * ratio)) greatest by a seeded hash of the key (none if ratio is 0), else train.

    Where that leaves none to train on, all rows are train and appear as eval too. Exact without a global sort: a histogram of
    the hash's first 16 bits finds the bin that the cut falls in, and only that bin is ranked.
    """
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key_col).cast("string")))
    rows = samples.withColumn("split_hash", h).withColumn("split_bin", F.substring("split_hash", 1, 4))
    bins = sorted(((r["split_bin"], r["n"]) for r in rows.groupBy("split_bin").agg(F.count("*").alias("n")).collect()), reverse=True)  # 65536 rows at most
    n = sum(x for _, x in bins)
    wanted = max(1, int(n * ratio)) if ratio > 0 and n else 0
    if wanted >= n:
        out = rows.drop("split_hash", "split_bin")
        train = out.withColumn("split", F.lit("train"))
        return train.unionByName(out.withColumn("split", F.lit("eval"))) if wanted else train
    left, cut = wanted, None
    for name, count in bins:
        if left < count:
            cut = name
            break
        left -= count
    w = Window.orderBy(F.desc("split_hash"), F.asc(key_col))
    edge = rows.where(F.col("split_bin") == cut).withColumn("nth", F.row_number().over(w)).withColumn("split", F.when(F.col("nth") <= left, "eval").otherwise("train")).drop("nth")
    rest = rows.where(F.col("split_bin") != cut).withColumn("split", F.when(F.col("split_bin") > cut, "eval").otherwise("train"))
    return rest.unionByName(edge).drop("split_hash", "split_bin")


def missing_keywords(docs: DataFrame, wanted: Iterable[str], text_col: str = "text") -> DataFrame:
    """(keyword, missing): whether no text holds the keyword. One pass, one row a task."""
    names = normalize_keywords(wanted)
    lower = F.lower(F.col(text_col))
    row = docs.agg(*(F.coalesce(F.bool_or(lower.contains(k)), F.lit(False)).alias(f"k{i}") for i, k in enumerate(names)))
    return row.select(F.explode(F.array(*(F.struct(F.lit(k).alias("keyword"), (~F.col(f"k{i}")).alias("missing")) for i, k in enumerate(names)))).alias("x")).select("x.*")


def topic_threshold(n: int) -> int:
    return max(1, min(n, 2), -(-4 * n // 10))


def topic_coverage(docs: DataFrame, topics: dict[str, Iterable[str]], text_col: str = "text") -> DataFrame:
    """(topic, threshold, most_hits, covered): covered if some text holds threshold of the topic's keywords or more. One pass over the texts."""
    lower = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    sets = {t: normalize_keywords(k) for t, k in sorted(topics.items())}
    hits = [F.coalesce(F.max(sum((F.when(lower.contains(k), 1).otherwise(0) for k in ks), F.lit(0))), F.lit(0)).alias(f"t{i}") for i, ks in enumerate(sets.values())]
    row = docs.agg(*hits)
    out = [
        F.struct(F.lit(t).alias("topic"), F.lit(topic_threshold(len(ks))).cast("bigint").alias("threshold"), F.col(f"t{i}").cast("bigint").alias("most_hits"), (F.col(f"t{i}") >= topic_threshold(len(ks))).alias("covered"))
        for i, (t, ks) in enumerate(sets.items())
    ]
    return row.select(F.explode(F.array(*out)).alias("x")).select("x.*")


def keyword_retrieve(questions: DataFrame, docs: DataFrame, top_k: int = 3, max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(query_id, id, score, rank): documents (id, text) by the share of a question's distinct keywords that are among theirs; 0 is dropped.

    Only keywords that some question has leave the scan; the questions' keywords go to all tasks if they are small enough. Ties go to the lesser id.
    """
    asked = questions.where("query_id is not null").select("query_id", F.array_distinct(keywords(F.coalesce("query", F.lit("")))).alias("ks")).select("query_id", F.size("ks").alias("n"), F.explode("ks").alias("k"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("k") + 16), F.lit(0))).first()[0]
    side = F.broadcast(asked) if size <= max_broadcast_bytes else asked
    own = docs.where("id is not null").select("id", F.explode(F.array_distinct(keywords(F.coalesce("text", F.lit(""))))).alias("word"))
    hits = own.join(side, F.col("word") == F.col("k")).groupBy("query_id", "id", "n").agg(F.count("*").alias("common"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    scored = hits.select("query_id", "id", F.round(F.col("common") / F.col("n"), 6).alias("score"))
    return scored.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= top_k)


def qa_pairs(questions: DataFrame, docs: DataFrame) -> DataFrame:
    """(query_id, id, text): each question with the text of its best document as the answer; questions that match none are left out."""
    best = keyword_retrieve(questions, docs, 1).select("query_id", "id")
    return best.join(questions, "query_id").join(docs.select("id", "text"), "id").select("query_id", "id", F.format_string("Question: %s\nAnswer: %s", F.trim("query"), F.trim("text")).alias("text"))


INSTRUCTIONS = "Use only the passages above to answer. Say so if they do not hold the answer."


def rag_prompts(hits: DataFrame, queries: DataFrame, word_limit: int | None = None) -> DataFrame:
    """(query_id, n_passages, prompt) from hits (query_id, fused_rank, url, titles, text): numbered passages in rank order, instructions, the question."""
    line = F.format_string("[%d] %s | %s\n%s", F.col("fused_rank"), F.col("url"), section_label(F.col("titles")), F.col("text"))
    packed = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("fused_rank", line.alias("line")))).alias("lines"))
    tail = INSTRUCTIONS + (f" Answer in {word_limit} words or fewer." if word_limit else "")
    body = F.array_join(F.transform("lines", lambda x: x["line"]), "\n\n")
    return packed.join(queries, "query_id").select("query_id", F.size("lines").cast("bigint").alias("n_passages"), F.concat(body, F.lit(f"\n\n{tail}\n\nQuestion: "), F.col("query")).alias("prompt"))


def perplexity(scored: DataFrame, log_prob: Column, mask: Column | None = None) -> DataFrame:
    """One row (perplexity) of token log-probabilities, over the tokens that mask keeps."""
    kept = log_prob if mask is None else F.when(mask, log_prob)
    return scored.agg(F.exp(-F.avg(kept)).alias("perplexity"))


def training_prompts(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, prompt) in the form that models are trained with: the hits' texts as numbered documents by rank, the question, an open answer.

    hits has (query_id, rank, text). A query without hits has the question alone.
    """
    packed = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", F.trim("text").alias("text")))).alias("docs"))
    line = lambda x, i: F.concat(F.lit("Document "), (i + 1).cast("string"), F.lit(":\n"), x["text"], F.lit("\n\n"))
    body = F.array_join(F.transform(F.coalesce("docs", F.array().cast("array<struct<rank:bigint,text:string>>")), line), "")
    return queries.join(packed, "query_id", "left").select("query_id", F.concat(body, F.lit("Question: "), F.trim("query"), F.lit("\nAnswer:")).alias("prompt"))
