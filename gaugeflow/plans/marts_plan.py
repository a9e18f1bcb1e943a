"""Marts over the proxy inputs: the composed plans behind the registered
queries for staging, dimension, fact and snapshot.

As in the pipeline, the raw daily table and the fact are *tables*: each is
written once to the shared folder (``spark.checkpoint.dir``) and read back,
which cuts the lineage (a lost executor recomputes from parquet, not from
lineitem) and lets every downstream pass read only the columns it needs. The
dimension (one row per entity) too, so its size is known when it is joined.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from gaugeflow.operators import marts
from gaugeflow.plans.proxy import PROXY_AS_OF, PROXY_MIN_DATE, proxy_catalog, proxy_raw
from gaugeflow.session import materialize


class ProxyMarts:
    """Inputs and marts of one run over ``sf_dir``; each table built once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return materialize(self.spark, proxy_raw(self.spark, self.sf_dir), "raw")

    @cached_property
    def catalog(self) -> DataFrame:
        return proxy_catalog(self.spark, self.sf_dir)

    @cached_property
    def staged(self) -> DataFrame:
        return marts.stage_daily(self.raw, as_of=PROXY_AS_OF, min_date=PROXY_MIN_DATE)

    @cached_property
    def dim(self) -> DataFrame:
        return materialize(self.spark, marts.build_dim(self.catalog, self.staged), "dim")

    def fact(self, split=True) -> DataFrame:
        return marts.build_fact(self.staged, self.dim, split=split)

    @cached_property
    def fact_table(self) -> DataFrame:
        return materialize(self.spark, self.fact(), "fact")

    def snapshot(self) -> DataFrame:
        return marts.build_snapshot(self.fact_table, self.dim)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ProxyMarts(spark, sf_dir).staged


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ProxyMarts(spark, sf_dir).dim


def fact(spark: SparkSession, sf_dir: str, split=True) -> DataFrame:
    return ProxyMarts(spark, sf_dir).fact(split=split)


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = ProxyMarts(spark, sf_dir)
    return marts.build_snapshot(m.fact(), m.dim)
