"""From raw listings to a table without nulls in the filled columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabmill.functions.text import to_number
from tabmill.operators import columns as C
from tabmill.operators import impute as I
from tabmill.operators.dedup import keep_first
from tabmill.operators.expand import expand_dict, expand_list
from tabmill.operators.profile import drop_sparse
from tabmill.plans.config import LISTINGS, ListingConfig
from tabmill.runtime import ident, staged


def typed(df: DataFrame, cfg: ListingConfig) -> DataFrame:
    """Text columns that hold only numbers become double, found in one pass."""
    candidates = [
        c for c in df.columns
        if c in cfg.number_columns or c in cfg.tech_columns or c.startswith(cfg.expanded_prefixes)
    ]
    candidates = [c for c in candidates if not C.is_numeric_type(df, c) and c != "image_urls_first"]
    numeric = C.infer_numeric(df, candidates)
    return C.replaced(df, {c: to_number(ident(c)) for c in numeric})


def clean(
    df: DataFrame,
    cfg: ListingConfig = LISTINGS,
    order: Sequence[str] | None = None,
    work_folder: str | None = None,
) -> DataFrame:
    """De-duplicate, expand nested text, drop sparse columns, fill nulls.

    `order` names the columns that say which row of a repeated id comes first.
    The expanded table is staged as Parquet, so that each fitting pass below
    reads just the columns it fits.
    """
    df = keep_first(df, [cfg.dedup_key], order) if cfg.dedup_key in df.columns else df
    for name in cfg.dict_columns:
        df = expand_dict(df, name)
    for name in cfg.list_columns:
        df = expand_list(df, name)
    df = C.drop_present(df, cfg.raw_columns)
    df = staged(df, "expanded", work_folder)
    df = typed(df, cfg)
    df = fill_identity(df, cfg)
    df = fill_details(df, cfg)
    return fill_expanded(df, cfg)


def fill_identity(df: DataFrame, cfg: ListingConfig) -> DataFrame:
    """Flags, sparse columns, ids, urls; then mark, model, year and mileage, each from the one before."""
    if "pts" in df.columns:
        df = I.presence_flag(df, "pts", "has_pts_info")
        df = I.fill_mode(df, ["pts"], 1)
    df = drop_sparse(df, cfg.sparse_threshold, cfg.sparse_exempt)
    df = C.keep_not_null(df, cfg.id_columns)
    df = C.blanks_to_empty(df, cfg.url_columns)
    have = set(df.columns)
    if "mark" in have:
        df = I.fill_mode(df, ["mark"])
    if {"mark", "model"} <= have:
        df = I.fill_group_mode(df, ["model"], ["mark"])
    if {"mark", "model", "year"} <= have:
        df = I.fill_group_median(df, ["year"], ["mark", "model"])
    if {"mark", "model", "year", "km_age"} <= have:
        df = I.fill_group_mean(df, ["km_age"], ["mark", "model", "year"])
    return df


def fill_details(df: DataFrame, cfg: ListingConfig) -> DataFrame:
    df = I.fill_typed(df, cfg.tech_columns, ["mark", "model"])
    df = I.fill_mode(df, cfg.seller_columns)
    df = C.keep_not_null(df, [cfg.created])
    df = I.fill_from(df, cfg.other_dates, cfg.created)
    df = I.fill_values(df, dict.fromkeys(cfg.free_text, ""))
    return I.fill_prices(df, cfg.price, cfg.price_low, cfg.price_high, cfg.zero_filled)


def fill_expanded(df: DataFrame, cfg: ListingConfig) -> DataFrame:
    return I.fill_fitted(df, C.by_prefix(df, cfg.expanded_prefixes))
