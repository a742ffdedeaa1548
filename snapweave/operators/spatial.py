"""Radius joins by grid cells, and acceptance of the nearest candidate."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapweave.functions.scalars import EARTH_RADIUS_M, haversine_m

METRES_PER_DEGREE = math.pi * EARTH_RADIUS_M / 180


def _steps(radius_m: float, max_latitude: float) -> tuple[float, float]:
    """Cell sizes in degrees of at least the radius, for all latitudes up to the given one."""
    lat = radius_m / METRES_PER_DEGREE * 1.001
    return lat, lat / max(math.cos(math.radians(min(max_latitude, 89.9))), 1e-3)


def radius_join(points: DataFrame, targets: DataFrame, radius_m: float, p_lat: str, p_lon: str, t_lat: str, t_lon: str, max_latitude: float = 80.0, on: list[str] | None = None, spread: int = 1) -> DataFrame:
    """Pairs of points and targets at most radius_m apart, with `distance_m`.

    Targets are copied to the nine cells around their own, points stay in one cell, and an equi-join on cell
    (and on the columns `on`, if given) makes the candidates; the great-circle distance decides. Crowded cells
    are dealt over `spread` tasks: points by a hash, targets copied to each. Cells are wide enough for latitudes up
    to max_latitude; a point or target beyond it raises, as pairs would be missed.
    """
    lat, lon = _steps(radius_m, max_latitude)
    cell = lambda a, o: (F.floor(a / lat), F.floor(o / lon))
    beyond = lambda c: F.when(F.abs(F.col(c)) > max_latitude, F.raise_error(F.concat(F.lit("latitude beyond max_latitude: "), F.col(c).cast("string"))).cast("double")).otherwise(F.col(c))
    px, py = cell(beyond(p_lat), F.col(p_lon))
    tx, ty = cell(beyond(t_lat), F.col(t_lon))
    around = F.array(*(F.struct((tx + i).alias("_x"), (ty + j).alias("_y")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    left = points.where(F.col(p_lat).isNotNull() & F.col(p_lon).isNotNull()).withColumns({"_x": px, "_y": py, "_s": F.pmod(F.xxhash64(*points.columns), F.lit(spread)).cast("int")})
    right = targets.where(F.col(t_lat).isNotNull() & F.col(t_lon).isNotNull()).withColumn("_c", F.explode(around)).withColumns({"_x": F.col("_c._x"), "_y": F.col("_c._y"), "_s": F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))}).drop("_c")
    distance = haversine_m(F.col(p_lat), F.col(p_lon), F.col(t_lat), F.col(t_lon))
    return left.join(right, ["_x", "_y", "_s", *(on or [])]).drop("_x", "_y", "_s").withColumn("distance_m", distance).where(F.col("distance_m") <= radius_m)


def first_targets(targets: DataFrame, at: list[str], *order: Column | str, n: int = 2) -> DataFrame:
    """The first n of targets that agree in the columns `at`: where these decide all but ties, no other can be among the n best of any point."""
    return targets.withColumn("_n", F.row_number().over(Window.partitionBy(*at).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


@dataclass(frozen=True)
class Weights:
    name: float = 0.58
    address: float = 0.17
    proximity: float = 0.25
    radius_m: float = 250.0


@dataclass(frozen=True)
class Acceptance:
    """Near-tie limits and (metres, least name score, least address score, name score that needs no address)."""

    tie_m: float = 12.0
    tie_name: float = 0.04
    tiers: tuple = ((20.0, 0.55, 0.0, 0.0), (75.0, 0.72, 0.35, 0.90), (200.0, 0.90, 0.55, 2.0))
    methods: tuple = ("coordinate_with_name_20m", "coordinate_name_address_75m", "coordinate_high_similarity_200m")  # fixed values
    low: float = 0.80
    high: float = 0.999
    bonus_near: float = 0.08
    bonus_far: float = 0.03

    def names(self) -> list[str]:
        """A method for each tier: the fixed values in order of the fixed tiers, of other tiers without own names their metres."""
        if len(self.methods) == len(self.tiers):
            return list(self.methods)
        if self.methods != Acceptance.methods:
            raise ValueError(f"{len(self.tiers)} tiers, but {len(self.methods)} methods")
        return [f"coordinate_{metres:g}m" for metres, *_ in self.tiers]


def combined_score(name: Column, address: Column, distance: Column, w: Weights = Weights()) -> Column:
    return w.name * name + w.address * address + w.proximity * F.greatest(F.lit(0.0), 1 - distance / w.radius_m)


def accept_nearest(candidates: DataFrame, key: str, name: str = "name_score", address: str = "address_score", tie: str = "target_id", rules: Acceptance = Acceptance(), weights: Weights = Weights()) -> DataFrame:
    """For each key its nearest candidate with status and score: matched, ambiguous (near tie) or null (not accepted).

    Candidates order by distance, then name and address score from high to low, then id.
    """
    w = Window.partitionBy(key).orderBy(F.col("distance_m"), F.col(name).desc(), F.col(address).desc(), F.col(tie))
    ranked = candidates.withColumns({"_n": F.row_number().over(w), "_d2": F.lead("distance_m").over(w), "_s2": F.lead(name).over(w)}).where("_n = 1")
    near_tie = F.col("_d2").isNotNull() & (F.col("_d2") - F.col("distance_m") < rules.tie_m) & (F.col("_s2") >= F.col(name) - rules.tie_name)
    tiers = []
    for (metres, least_name, least_address, enough), named in zip(rules.tiers, rules.names(), strict=True):
        fits = F.col(name) >= least_name
        if least_address:
            fits = fits & ((F.col(address) >= least_address) | (F.col(name) >= enough))
        tiers.append(F.when((F.col("distance_m") <= metres) & fits, F.lit(named)))
    tier = F.coalesce(*tiers, F.lit(None).cast("string"))
    ok = tier.isNotNull()
    bonus = F.when(F.col("distance_m") <= rules.tiers[0][0], rules.bonus_near).otherwise(rules.bonus_far)
    score = F.least(F.lit(rules.high), F.greatest(F.lit(rules.low), combined_score(F.col(name), F.col(address), F.col("distance_m"), weights) + bonus))
    status = F.when(near_tie, "ambiguous").when(ok, "matched")
    method = F.when(near_tie, "coordinate_near_tie").when(ok, tier)
    return ranked.withColumns({"status": status, "method": method, "score": F.when(status == "matched", score).otherwise(0.0)}).drop("_n", "_d2", "_s2")
