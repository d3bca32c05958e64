"""The operators as queries on whole tables, with production parameters."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barforge.functions.storage import stored
from barforge.llm import (
    decontaminate, html, licenses, mixing, neighbours, pii, quality, secrets, simhash, spelling, toxicity, urls, whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document in the dealt mixture of all."""
    return mixing.words_taken(table(spark, sf_dir, "documents"), weights=(5, 2, 1), cap=3)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, and the component that its links reach."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, max_bits=3)
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in documents: five-word shingles, similarity of 0.8 or more."""
    found = decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=5, similarity=0.8)
    return found.select("doc_id", "item_id", *(F.col(c).cast("bigint").alias(c) for c in ("part", "start", "length")), "similarity")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for every fiftieth id, among all."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    graph = neighbours.build_graph(vectors)
    return neighbours.search(graph, vectors.where("vec_id % 50 = 0"), k=5)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced, and where it stood in the old text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.pseudonymise(docs, key="of the registered query")
    return found.select(
        "doc_id", "text", F.size("personal").cast("bigint").alias("n_found"),
        F.array_join(F.transform("personal", lambda p: F.concat_ws(":", p.kind, p.start, p.end)), ",").alias("spans"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract_text(pages).drop("html").withColumn("n_chars", F.length("text").cast("bigint"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets per document: counts per known kind, digest of those spans, all spans."""
    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s.kind == kind)).cast("bigint")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(
            spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    known = F.filter("secrets", lambda s: s.kind.isin([k[0] for k in secrets.KNOWN]))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan_secrets(docs).select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind, *_ in secrets.KNOWN),
        F.sha2(joined(known), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labels of those not held out."""
    docs = table(spark, sf_dir, "documents")
    stats = stored(docs.select("doc_id", quality.text_statistics(F.col("text")).alias("stats")), "statistics")
    labels = table(spark, sf_dir, "labels").where(~quality.held_out())
    model = quality.fit_quality(stats, labels)
    return stats.select(
        "doc_id", quality.held_out().alias("held_out"), model.score(F.col("stats")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named or quoted in every document: places of the base phrases, labels, score."""
    def labels(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(docs)
    base = F.filter("licenses", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"].cast("bigint"))
    return found.select("doc_id", "n_words", "licenses", base.alias("base"), starts.alias("starts")).select(
        "doc_id", "n_words", F.size("starts").cast("bigint").alias("n_base"),
        F.array_min("starts").alias("first_word"), F.array_max("starts").alias("last_word"),
        labels(F.col("base")).alias("base_labels"), labels(F.col("licenses")).alias("labels"),
        F.coalesce(F.array_max(F.transform("licenses", lambda p: p["score"])), F.lit(0.0)).alias("score"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge_urls(
        pages, block=("net/", "example.com/de/"), allow=("example.net/en/", "org/fr/")).select(
            "page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first four whitened components."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors, levels=256, components=4)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"), times=10)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labels of those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    model = toxicity.fit_toxicity(docs, labels)
    return docs.select(
        "doc_id", toxicity.held_out().alias("held_out"), model.score(F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_simhash": op2_simhash,
    "op3_decontamination": op3_decontamination,
    "op4_neighbours": op4_neighbours,
    "op5_pii": op5_pii,
    "op6_html": op6_html,
    "op7_secrets": op7_secrets,
    "op8_quality": op8_quality,
    "op9_licenses": op9_licenses,
    "op10_urls": op10_urls,
    "op11_whitening": op11_whitening,
    "op12_spelling": op12_spelling,
    "op13_toxicity": op13_toxicity,
}
