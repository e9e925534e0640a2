"""Registered queries of this subpackage: thin views of the operators over the production tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import decontamination, language_id, licences, mixing, pii, quality_classifier, quality_rules, simhash, substrings, url_filters
from textloom.llm.common import read


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(read(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.digest(read(spark, sf_dir, "pages"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digest(read(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(read(spark, sf_dir, "documents"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(read(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digest(read(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_mixing": op2_mixing,
    "op3_substrings": op3_substrings,
    "op4_quality_rules": op4_quality_rules,
    "op5_url_filters": op5_url_filters,
    "op6_licences": op6_licences,
    "op7_simhash": op7_simhash,
    "op8_language_id": op8_language_id,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_pii": op10_pii,
}
ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": decontamination.ORACLE,
    "op2_mixing": mixing.ORACLE,
    "op3_substrings": substrings.ORACLE,
    "op4_quality_rules": quality_rules.ORACLE,
    "op5_url_filters": url_filters.ORACLE,
    "op6_licences": licences.ORACLE,
}
