"""Road markings and tiles classified by the state of their pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# States of a pixel, and the names of the types by number.
STATES = {1: "gut", 2: "mittel", 3: "schlecht"}
TYPES = ("Linie dünn", "Linie dünn gestrichelt", "Linie breit", "Linie breit gestrichelt", "Linie extrabreit", "NULL", "Pfeile", "Symbole", "Sperrflächen")


def state_of(mid: Column, bad: Column, t_mid: float = 0.25, t_bad: float = 0.25) -> Column:
    """mid, bad: percentages. 'schlecht' beats 'mittel' beats 'gut'; null percentages give 'gut'."""
    return F.when(bad / 100.0 >= t_bad, "schlecht").when((mid + bad) / 100.0 >= t_mid, "mittel").otherwise("gut")


def pixel_shares(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """pixels(keys, type_id, cond_id) → per object: typ (the commonest type of all its pixels, the lowest of equal ones), percentages of the states, n.

    The percentages are of the n pixels with a condition; objects without any such pixel don't appear. Null types don't count.
    """
    n = F.count_if(F.col("cond_id") > 0)
    shares = [F.try_divide(F.count_if(F.col("cond_id") == k) * F.lit(100.0), n).alias(s) for k, s in STATES.items()]
    return pixels.groupBy(*keys).agg(F.mode("type_id", True).alias("typ"), n.alias("n"), *shares).filter("n > 0")


def classify_markings(pixels: DataFrame, keys: list[str], t_mid: float = 0.25, t_bad: float = 0.25) -> DataFrame:
    shares = pixel_shares(pixels, keys)
    return shares.withColumn("zustand", state_of(F.col("mittel"), F.col("schlecht"), t_mid, t_bad))


def type_name(type_id: Column) -> Column:
    return F.get(F.array(*map(F.lit, TYPES)), type_id - 1)


def reclassify_markings(markings: DataFrame, t_mid: float = 0.25, t_bad: float = 0.25) -> DataFrame:
    """Stored markings(mittel, schlecht, …) with zustand told anew from their percentages; what else they have stays."""
    state = state_of(F.col("mittel"), F.col("schlecht"), t_mid, t_bad)
    return markings.select(*[F.col(f"`{c}`") for c in markings.columns if c != "zustand"], state.alias("zustand"))


def condition_table(pixels: DataFrame, ignore: tuple[int, ...] = ()) -> DataFrame:
    """Pixels per tile, type and condition, with the share of the tile and of the type (ignored types left out of the tile)."""
    counts = pixels.filter(~F.col("type_id").isin(*ignore) if ignore else F.lit(True)).groupBy("tile", "type_id", "cond_id").agg(F.count(F.lit(1)).alias("n"))
    of = lambda *k: F.sum("n").over(W.partitionBy(*k))  # at most types × conditions rows a tile
    return counts.select("tile", "type_id", "cond_id", "n", (F.col("n") * F.lit(100.0) / of("tile")).alias("of_tile"), (F.col("n") * F.lit(100.0) / of("tile", "type_id")).alias("of_type"))


def classify_tiles(table: DataFrame, type_weight: Column, mid: float = 0.2, bad_mid: float = 0.02, bad: float = 0.3) -> DataFrame:
    """table(tile, type_id, cond_id, n) → tile, shares of the states weighted by type, and the state; null without weight.

    type_weight may also depend on cond_id (see weight_of).
    """
    w = F.sum(F.when(F.col("cond_id") > 0, F.col("n") * type_weight))
    part = lambda k: F.try_divide(F.sum(F.when(F.col("cond_id") == k, F.col("n") * type_weight).otherwise(F.lit(0.0))), w)
    s = table.groupBy("tile").agg(*[part(k).alias(v) for k, v in STATES.items()])
    return s.withColumn("zustand", tile_state(mid, bad_mid, bad))


def tile_state(mid: float = 0.2, bad_mid: float = 0.02, bad: float = 0.3) -> Column:
    """State of a tile from its shares gut, mittel and schlecht; null if they are null."""
    middling = (F.col("mittel") + F.col("schlecht") >= mid) | (F.col("schlecht") >= bad_mid)
    return F.when(F.col("schlecht") >= bad, "schlecht").when(middling, "mittel").when(F.col("gut").isNotNull(), "gut")


def weight_of(factors: dict[tuple[int, int], float]) -> Column:
    """Weight of a pixel from factors by (cond_id, type_id); 0 for others."""
    pairs = F.create_map(*[F.lit(v) for (c, t), f in factors.items() for v in (c * 100 + t, float(f))])
    return F.coalesce(F.try_element_at(pairs, F.col("cond_id") * 100 + F.col("type_id")), F.lit(0.0))


def empty_tiles(tiles: DataFrame) -> DataFrame:
    """tiles(tile) as rows of classify_tiles() without any value, for tiles that nothing was found in."""
    none = F.lit(None)
    return tiles.select("tile", *[none.cast("double").alias(s) for s in STATES.values()], none.cast("string").alias("zustand"))


def merge_types(type_id: Column, pairs: dict[int, int]) -> Column:
    """Type numbers with some put together, as 2 → 1 and 4 → 3 before outlines are drawn."""
    out = type_id
    for a, b in pairs.items():
        out = F.when(type_id == a, b).otherwise(out)
    return out
