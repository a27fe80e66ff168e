"""The registered queries opN_<name>: each applies its operator, with production parameters, to the whole table.

``QUERIES`` maps names to ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` holds DuckDB SQL where SQL can
express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


from mercato.llm import quality  # noqa: E402


@query("op6_quality", quality.oracle())
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.verdicts(docs).select("doc_id", *[f"_quality.{c}" for c in quality.COUNTS], "_quality.base_failed",
                                         "_quality.kept", "_quality.lang")


from mercato.llm import fingerprints, html_text, mixing  # noqa: E402


@query("op1_html_text")
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_main_text(table(spark, sf_dir, "pages"))


@query("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text."""
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


@query("op5_mixing", mixing.oracle())
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.with_copies(docs).select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", "_mix.taken")


from mercato.llm import packing, sharding, token_files  # noqa: E402


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of all documents as ORC and describe them from the files."""
    folder = shared_folder(spark, "token-files")
    token_files.write_ids(table(spark, sf_dir, "documents").select("doc_id", "text"), folder)
    return token_files.digests(spark, folder)


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents into 8 shards and describe them from the files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = shared_folder(spark, "shards")
    sharding.write_shards(docs, folder)
    return sharding.digests(docs, folder)


from mercato.llm import minhash  # noqa: E402


@query("op2_minhash")
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, Jaccard at least 0.85."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.groups(docs, k=3, percent=85, bands=32, rows=5).select(
        "doc_id", "n_shingles", "component_id", "kept", "class_id")


from mercato.llm import pii  # noqa: E402


@query("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


from mercato.llm import passages  # noqa: E402


@query("op4_passages")
def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that documents share."""
    return passages.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


from mercato.llm import whitening  # noqa: E402


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


from mercato.llm import conversations  # noqa: E402


@query("op13_conversations")
def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation after planted damage."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.digests(conversations.damaged(rows), rows.select("conv_id"))


from mercato.llm import url_filter  # noqa: E402


@query("op11_url_filter", url_filter.oracle())
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
