"""Checks, enrichment and de-duplication of the two batch feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.model import INVENTORY, POS
from shelfline.operators import dedup, enrich, validate
from shelfline.plans.batch import to_silver
from shelfline.queries.registry import query
from shelfline.sources import tables

def _pos_checked(spark, sf):
    raw = enrich.stamp_date(tables.pos_raw(spark, sf), tables.RUN_DATE)
    return validate.check(raw, POS)


def _inventory_checked(spark, sf):
    raw = enrich.stamp_date(tables.inventory_raw(spark, sf), tables.RUN_DATE)
    return validate.check(raw, INVENTORY)


def _pos_enriched(spark, sf):
    return enrich.enrich_pos(validate.valid_rows(_pos_checked(spark, sf)))


def _inventory_enriched(spark, sf):
    return enrich.enrich_inventory(validate.valid_rows(_inventory_checked(spark, sf)))


def pos_silver(spark, sf):
    return to_silver(validate.valid_rows(_pos_checked(spark, sf)), POS)


def inventory_silver(spark, sf):
    return to_silver(validate.valid_rows(_inventory_checked(spark, sf)), INVENTORY)


@query
def pos_valid(spark, sf):
    return validate.valid_rows(_pos_checked(spark, sf))


@query
def pos_invalid(spark, sf):
    return validate.invalid_rows(_pos_checked(spark, sf))


@query
def inventory_valid(spark, sf):
    return validate.valid_rows(_inventory_checked(spark, sf))


@query
def inventory_invalid(spark, sf):
    return validate.invalid_rows(_inventory_checked(spark, sf))


@query
def pos_text_valid(spark, sf):
    return validate.valid_rows(validate.check(tables.pos_text(spark, sf), POS))


@query
def pos_text_invalid(spark, sf):
    return validate.invalid_rows(validate.check(tables.pos_text(spark, sf), POS))


@query
def pos_missing_column(spark, sf):
    """A frame without a required column is rejected whole."""
    return validate.invalid_rows(
        validate.check(tables.pos_raw(spark, sf).drop("store_id", "quantity"), POS)
    )


@query
def inventory_missing_nullable(spark, sf):
    """An absent nullable column is filled with NULL and rejects nothing."""
    raw = tables.inventory_raw(spark, sf).drop("restock_threshold")
    return validate.valid_rows(validate.check(raw, INVENTORY))


@query
def pos_validation_summary(spark, sf):
    return validate.summary(_pos_checked(spark, sf))


@query
def inventory_validation_summary(spark, sf):
    return validate.summary(_inventory_checked(spark, sf))


@query
def pos_enriched(spark, sf):
    return _pos_enriched(spark, sf)


@query
def inventory_enriched(spark, sf):
    return _inventory_enriched(spark, sf)


@query
def pos_dedup(spark, sf):
    return pos_silver(spark, sf)


@query
def inventory_dedup(spark, sf):
    return inventory_silver(spark, sf)


@query
def dedup_report(spark, sf):
    pos = dedup.dedup_report(_pos_enriched(spark, sf), POS.key)
    inv = dedup.dedup_report(_inventory_enriched(spark, sf), INVENTORY.key)
    return pos.withColumn("source_type", F.lit(POS.name)).unionByName(
        inv.withColumn("source_type", F.lit(INVENTORY.name))
    )


@query
def lineitem_dedup(spark, sf):
    rows = tables.table(spark, sf, "lineitem")
    return dedup.latest_per_key(rows, ["l_orderkey", "l_linenumber"], "l_shipdate")
