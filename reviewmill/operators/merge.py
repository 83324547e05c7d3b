"""The ledger merge: one plan over all listings.

A harvest may always add; it may only remove if it was complete. Listings without a
harvest are left as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATES = ("active", "unconfirmed", "tombstoned", "suppressed")
COMPLETE = ("full", "full_capped")
OUTCOMES = ("INSERTED", "UPDATED", "UNCHANGED", "MISSING", "TOMBSTONED", "SUPPRESSED", "IGNORED_TERMINAL", "HELD")
#: What a stop reason says about completeness; any other is a failure.
COMPLETENESS = {"exhausted": "full", "target_reached": "full", "cap_reached": "full_capped", "stalled": "partial", "budget_exceeded": "partial", "blocked": "failed", "error": "failed"}
CONFIRMATIONS = 3


def completeness_of(stop_reason: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(v) for k, c in COMPLETENESS.items() for v in (k, c)])[stop_reason], F.lit("failed"))


def reconcile(ledger: DataFrame, observed: DataFrame, harvests: DataFrame, denylist: DataFrame, confirmations: int = CONFIRMATIONS, carried: tuple[str, ...] = (), pinned: tuple[str, ...] = ()) -> DataFrame:
    """Ledger rows after the harvests, each with its outcome (null where the listing had none).

    carried: further columns of ledger and observed, of which an insert or update takes what was observed. pinned: further columns that keep what was
    observed first, such as a date estimated from "2 months ago", which would move with every harvest.

    ledger: listing, id, content_hash, state, first_seen_at, last_seen_at, last_updated_at, revision, missing_streak,
    tombstoned_at, history. observed: listing, id, content_hash (one row of each). harvests: listing, now, completeness,
    last_full_harvest_at. denylist: id. A review is taken for removed after 2 to 10 complete harvests without it.
    """
    if not 2 <= confirmations <= 10:
        raise ValueError("confirmations must be 2 to 10")
    seen = observed.join(harvests.select("listing"), "listing", "left_semi").select("listing", "id", F.col("content_hash").alias("o_hash"), *(F.col(c).alias(f"o_{c}") for c in (*carried, *pinned)), F.lit(True).alias("o"))
    known = ledger.withColumn("p", F.lit(True))
    j = known.join(seen, ["listing", "id"], "full_outer").join(harvests, "listing", "left").join(denylist.select("id", F.lit(True).alias("denied")).distinct(), "id", "left")
    present, prior, denied = F.col("o").isNotNull(), F.col("p").isNotNull(), F.col("denied").isNotNull()
    terminal = F.col("state").isin("tombstoned", "suppressed")
    on_observed = F.when(denied, "SUPPRESSED").when(prior & terminal, "IGNORED_TERMINAL").when(~prior, "INSERTED").when(F.col("content_hash") == F.col("o_hash"), "UNCHANGED").otherwise("UPDATED")
    counted = F.coalesce(F.col("last_full_harvest_at") == F.col("now"), F.lit(False))
    on_absent = F.when(terminal, "IGNORED_TERMINAL").when(~F.col("completeness").isin(*COMPLETE), "HELD").when(counted, "HELD").when(F.col("missing_streak") + 1 >= confirmations, "TOMBSTONED").otherwise("MISSING")
    outcome = F.when(F.col("now").isNotNull(), F.when(present, on_observed).otherwise(on_absent))
    out = j.withColumn("outcome", outcome).where(prior | (F.col("outcome") != "SUPPRESSED"))
    is_ = lambda *names: F.coalesce(F.col("outcome").isin(*names), F.lit(False))
    swept = denied & prior & F.col("now").isNotNull()
    changed = is_("INSERTED", "UPDATED")
    return out.select(
        "listing", "id", "outcome",
        F.when(changed, F.col("o_hash")).otherwise(F.col("content_hash")).alias("content_hash"),
        F.when(swept, "suppressed").when(is_("INSERTED", "UPDATED", "UNCHANGED"), "active").when(is_("MISSING"), "unconfirmed").when(is_("TOMBSTONED"), "tombstoned").otherwise(F.col("state")).alias("state"),
        F.when(is_("INSERTED"), F.col("now")).otherwise(F.col("first_seen_at")).alias("first_seen_at"),
        F.when(is_("INSERTED", "UPDATED", "UNCHANGED"), F.col("now")).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        F.when(changed, F.col("now")).otherwise(F.col("last_updated_at")).alias("last_updated_at"),
        F.when(is_("INSERTED"), 1).when(is_("UPDATED"), F.col("revision") + 1).otherwise(F.col("revision")).alias("revision"),
        F.when(is_("INSERTED", "UPDATED", "UNCHANGED"), 0).when(is_("MISSING", "TOMBSTONED"), F.col("missing_streak") + 1).otherwise(F.col("missing_streak")).alias("missing_streak"),
        F.when(changed, None).when(is_("TOMBSTONED"), F.col("now")).otherwise(F.col("tombstoned_at")).alias("tombstoned_at"),
        F.when(is_("INSERTED"), F.array().cast("array<string>")).when(is_("UPDATED"), F.array_append("history", F.col("content_hash"))).otherwise(F.col("history")).alias("history"),
        *(F.when(changed, F.col(f"o_{c}")).otherwise(F.col(c)).alias(c) for c in carried), *(F.when(is_("INSERTED"), F.col(f"o_{c}")).otherwise(F.col(c)).alias(c) for c in pinned),
    )


def record_harvests(known: DataFrame, harvests: DataFrame) -> DataFrame:
    """(listing, updated_at, last_full_harvest_at) after the harvests: a complete one sets both times, another one only the first."""
    j = known.join(harvests.select("listing", "now", "completeness"), "listing", "full_outer")
    full = F.coalesce(F.col("completeness").isin(*COMPLETE), F.lit(False))
    return j.select("listing", F.coalesce("now", "updated_at").alias("updated_at"), F.when(full, F.col("now")).otherwise(F.col("last_full_harvest_at")).alias("last_full_harvest_at"))


def tally(merged: DataFrame, *by: str) -> DataFrame:
    return merged.groupBy(*by).agg(*(F.count_if(F.col("outcome") == o).alias(o.lower()) for o in OUTCOMES))


def violations(ledger: DataFrame, key: str = "id", identity: str | None = None) -> DataFrame:
    """Rows that break an invariant, with the names of those they break; ``suspect`` names what is odd but not forbidden.

    identity: the column of the record's own identity, where that is kept beside the key.
    """
    rules = {
        "key": ~F.col(identity or key).eqNullSafe(F.col(key)), "revision": F.col("revision") < 1, "streak": F.col("missing_streak") < 0,
        "tombstone_without_time": (F.col("state") == "tombstoned") & F.col("tombstoned_at").isNull(), "seen_before_first": F.col("first_seen_at") > F.col("last_seen_at"),
        "history": F.size("history") != F.col("revision") - 1,
    }
    odd = {"state": ~F.col("state").isin(*STATES), "active_with_streak": (F.col("state") == "active") & (F.col("missing_streak") > 0)}
    named = lambda found: F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in found.items())))
    return ledger.withColumns({"broken": named(rules), "suspect": named(odd)}).where(F.size("broken") > 0)


def publishable(state: Column) -> Column:
    """Unconfirmed reviews are still published."""
    return ~state.isin("tombstoned", "suppressed")
