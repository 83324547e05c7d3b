"""Which targets are due, in which order, and under which budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def due(enabled: Column, paused: Column, last_run: Column, now: Column, cadence_h: Column, floor_h: Column) -> tuple[Column, Column]:
    """(due, reason)."""
    ready = now >= last_run + F.greatest(cadence_h, floor_h)
    return F.when(~enabled | paused, False).when(last_run.isNull(), True).otherwise(ready), F.when(~enabled, "disabled").when(paused, "paused").when(last_run.isNull(), "never_run").when(ready, "due").otherwise("fresh")


def budget_grants(requests: DataFrame, *by: str, per_hour: int, per_day: int) -> DataFrame:
    """granted of each request (by..., ts, id). A denied request uses nothing; hours nest in days, so the rank within
    the hour and then the rank within the day of what the hour let through is the sequential rule."""
    hour, day = F.date_format("ts", "yyyy-MM-dd'T'HH"), F.date_format("ts", "yyyy-MM-dd")
    h = requests.withColumns({"hour_key": hour, "day_key": day}).withColumn("_h", F.row_number().over(Window.partitionBy(*by, "hour_key").orderBy("ts", "id")) <= per_hour)
    passed = F.sum(F.col("_h").cast("int")).over(Window.partitionBy(*by, "day_key").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0))
    return h.withColumn("granted", F.col("_h") & (passed <= per_day)).drop("_h")


def quiet_run(rows: DataFrame, *by: str, order: str, value: str) -> DataFrame:
    """The last value of each series and how many steps before its end it was reached."""
    w = Window.partitionBy(*by).orderBy(order)
    changed = rows.withColumn("_c", F.coalesce((F.col(value) != F.lag(value).over(w)).cast("int"), F.lit(0)))
    groups = changed.withColumn("_g", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    top = groups.groupBy(*by, "_g").agg(F.count("*").alias("n"), F.max(order).alias("o"), F.first(value).alias("last_value"))
    return top.groupBy(*by).agg(F.max_by("last_value", "o").alias("last_value"), (F.max_by("n", "o") - 1).cast("int").alias("quiet"))


def stop_reason(seen: Column, cap: Column, target: Column, quiet: Column, advertised: Column, budget_left: Column) -> Column:
    exhausted = (advertised > 0) & (seen >= F.lit(0.95) * advertised)
    return F.when(seen >= cap, "cap_reached").when(seen >= target, "target_reached").when(quiet >= 3, F.when(exhausted, "exhausted").otherwise("stalled")).when(budget_left <= 0, "budget_exceeded").otherwise("continue")


def shards(costs: list[tuple[str, float]], n: int) -> list[tuple[str, int]]:
    """Longest cost first to the least loaded shard, the lowest on ties. On the driver: a plan has thousands of targets at most."""
    load, out = [0.0] * n, []
    for key, cost in sorted(costs, key=lambda x: (-x[1], x[0])):
        k = min(range(n), key=lambda i: (load[i], i))
        load[k] += cost
        out.append((key, k))
    return out


def balance(load: Column) -> Column:
    """Largest over smallest load: 1 if both are 0, infinite if only the smallest is."""
    return F.when((F.max(load) == 0) & (F.min(load) == 0), 1.0).when(F.min(load) == 0, float("inf")).otherwise(F.max(load) / F.nullif(F.min(load), F.lit(0)))


def fnv1a(c: Column) -> Column:
    """32-bit FNV-1a of a text, by UTF-16 units: of a character beyond 16 bits, its two surrogates."""
    units = F.flatten(F.transform(F.split(c, ""), lambda x: F.when(F.ascii(x) < 0x10000, F.array(F.ascii(x))).otherwise(F.array(F.shiftright(F.ascii(x) - 0x10000, 10) + 0xD800, ((F.ascii(x) - 0x10000) % 1024) + 0xDC00))))
    return F.aggregate(F.when(c == "", F.array().cast("array<int>")).otherwise(units), F.lit(0x811C9DC5).cast("long"), lambda h, u: (h.bitwiseXOR(u.cast("long")) * F.lit(0x01000193)).bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))


def seeded_order(targets: DataFrame, run_id: str, key: str = "target") -> DataFrame:
    """position by the hash of run and key, then key."""
    return targets.withColumn("order_hash", fnv1a(F.concat(F.lit(f"{run_id}:"), F.col(key)))).orderBy("order_hash", key)
