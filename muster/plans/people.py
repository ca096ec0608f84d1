"""Who may be written to at all, and where they live."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.config import MailingConfig

SUPPRESSIONS = ("suppressed_isp", "suppressed_inactive", "suppressed_seed")


def in_states(state: Column, cfg: MailingConfig) -> Column:
    """Configured state restriction; a null state meets no restriction."""
    allowed = F.lit(True)
    if cfg.state_whitelist:
        allowed = allowed & state.isin(*cfg.state_whitelist)
    if cfg.state_blacklist:
        allowed = allowed & ~state.isin(*cfg.state_blacklist)
    return allowed


def unsuppressed(people: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Drop everyone on any suppression list.

    The lists are put together first: one anti join moves the people once.
    """
    lists = [tables[name].select("cons_id") for name in SUPPRESSIONS]
    suppressed = reduce(DataFrame.unionByName, lists).distinct()
    return people.join(suppressed, "cons_id", "left_anti")


def with_zip_fallback(addresses: DataFrame, zips: DataFrame) -> DataFrame:
    """Addresses with the centre of their zip area where coordinates are missing.

    Null and zero both count as missing, but only an address that is null
    itself and in an unknown zip area is dropped here; a zero in an unknown
    area stays, with null coordinates.
    """
    centres = zips.select(
        "zip", F.col("latitude").alias("_zip_lat"), F.col("longitude").alias("_zip_lon")
    )

    def or_centre(own: str, centre: str) -> Column:
        missing = F.col(own).isNull() | (F.col(own) == 0)
        return F.when(missing, F.col(centre)).otherwise(F.col(own))

    known = F.lit(True)
    for own, centre in (("latitude", "_zip_lat"), ("longitude", "_zip_lon")):
        known = known & (F.col(own).isNotNull() | F.col(centre).isNotNull())
    return (
        addresses.join(centres, "zip", "left")
        .where(known)
        .withColumns(
            {
                "latitude": or_centre("latitude", "_zip_lat"),
                "longitude": or_centre("longitude", "_zip_lon"),
            }
        )
        .drop("_zip_lat", "_zip_lon")
    )


def build_constituents(cfg: MailingConfig, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Subscribed, unsuppressed people with a primary address and e-mail.

    Subscriptions are moved twice, by e-mail id and then by person; the
    suppression lists are taken off the names, which meet them by person too.
    """
    subscribed = (
        tables["cons_sub"]
        .where((F.col("isunsub") == 0) & (F.col("chapter_id") == cfg.chapter_id))
        .select("cons_id", "cons_email_id")
    )
    emails = tables["cons_email"].where("is_primary").select("cons_email_id", "email")
    names = unsuppressed(tables["cons"].select("cons_id", "firstname", "lastname"), tables)
    addresses = (
        tables["cons_addr"]
        .where((F.col("is_primary") == 1) & in_states(F.col("state_cd"), cfg))
        .drop("is_primary")
    )
    state_names = tables["state_abbr"].select(
        F.col("state_abbr").alias("state_cd"), F.col("state").alias("state_name")
    )
    return (
        subscribed.join(emails, "cons_email_id")
        .join(names, "cons_id")
        .join(with_zip_fallback(addresses, tables["zips"]), "cons_id")
        .join(state_names, "state_cd", "left")
        .select(
            F.lit(cfg.ds).alias("ds"),
            "email", "cons_id", "firstname", "lastname", "addr1", "city",
            "state_cd", "state_name", "zip", "latitude", "longitude",
        )
    )
