"""The dealt operators as named queries over a folder of tables, and their SQL."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.bpe import Vocabulary, token_digests
from kerbside.llm.cap_filters import near_duplicate_vectors
from kerbside.llm.chunking import passage_digest, repeated_passages
from kerbside.llm.digest_runs import ORACLE as DIGEST_RUNS_ORACLE
from kerbside.llm.digest_runs import exact_duplicates
from kerbside.llm.filter_audit import audit_filters, failures
from kerbside.llm.filter_audit import oracle as filter_audit_oracle
from kerbside.llm.licenses import oracle as licenses_oracle
from kerbside.llm.licenses import scan_licenses
from kerbside.llm.minhash import near_duplicates
from kerbside.llm.mixing import ORACLE as MIXING_ORACLE
from kerbside.llm.mixing import mix_sources
from kerbside.llm.multi_index import nearest_neighbours
from kerbside.llm.periodic_runs import periodic_runs, runs_digest
from kerbside.llm.personal import find_personal_data, personal_data_digest
from kerbside.llm.resampling import resample, target_share
from kerbside.llm.toxicity import score_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, tables: str) -> DataFrame:
    return spark.read.parquet(f"{tables}/documents.parquet")


def op6_multi_index_search(spark: SparkSession, tables: str) -> DataFrame:
    return nearest_neighbours(embeddings(spark, tables), F.col("id") % 50 == 0)


def vocabulary(spark: SparkSession, path: str | None = None) -> Vocabulary:
    return Vocabulary(spark, path or public_tokenizers.path("word_bpe_49k.json"))


def op8_importance_resampling(spark: SparkSession, tables: str) -> DataFrame:
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    # As many rows as the labels say are of the target quality; the default share without labels.
    share = target_share(labels, "quality = 1")
    size = {} if share is None else {"share": share}
    return resample(documents(spark, tables), labels.filter("quality = 1"), **size)


def op9_license_scan(spark: SparkSession, tables: str) -> DataFrame:
    return scan_licenses(documents(spark, tables))


def embeddings(spark: SparkSession, tables: str) -> DataFrame:
    return spark.read.parquet(f"{tables}/embeddings.parquet")


def op1_cap_filter_dedup(spark: SparkSession, tables: str) -> DataFrame:
    return near_duplicate_vectors(embeddings(spark, tables))


def op2_poisson_mix(spark: SparkSession, tables: str) -> DataFrame:
    return mix_sources(documents(spark, tables))


def op3_minhash_dedup(spark: SparkSession, tables: str) -> DataFrame:
    return near_duplicates(documents(spark, tables))


def op4_personal_data(spark: SparkSession, tables: str) -> DataFrame:
    return personal_data_digest(find_personal_data(documents(spark, tables)))


def op5_toxicity(spark: SparkSession, tables: str) -> DataFrame:
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    return score_toxicity(documents(spark, tables), labels)


def op7_bpe_tokens(spark: SparkSession, tables: str) -> DataFrame:
    return token_digests(documents(spark, tables), vocabulary(spark))


def op10_chunk_dedup(spark: SparkSession, tables: str) -> DataFrame:
    return passage_digest(repeated_passages(documents(spark, tables), every_place=True))


def op11_periodic_runs(spark: SparkSession, tables: str) -> DataFrame:
    return runs_digest(periodic_runs(documents(spark, tables), loops=True))


def op12_filter_audit(spark: SparkSession, tables: str) -> DataFrame:
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    return audit_filters(failures(documents(spark, tables), labels))


def op13_digest_runs(spark: SparkSession, tables: str) -> DataFrame:
    return exact_duplicates(documents(spark, tables), keep="largest")


QUERIES: dict[str, Query] = {
    "op1_cap_filter_dedup": op1_cap_filter_dedup,
    "op2_poisson_mix": op2_poisson_mix,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_personal_data": op4_personal_data,
    "op5_toxicity": op5_toxicity,
    "op6_multi_index_search": op6_multi_index_search,
    "op7_bpe_tokens": op7_bpe_tokens,
    "op8_importance_resampling": op8_importance_resampling,
    "op9_license_scan": op9_license_scan,
    "op10_chunk_dedup": op10_chunk_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_filter_audit": op12_filter_audit,
    "op13_digest_runs": op13_digest_runs,
}

ORACLE: dict[str, str] = {
    "op2_poisson_mix": MIXING_ORACLE,
    "op9_license_scan": licenses_oracle(),
    "op12_filter_audit": filter_audit_oracle(),
    "op13_digest_runs": DIGEST_RUNS_ORACLE,
}
