"""The full state object of a tracked entity: place, arrival, delay and risk beside its newest event.

The documents name the fields without defining them.  Here the city is that of the nearest
warehouse, the arrival follows from distance left and speed, and the delay probability joins the lane's
record with how late the arrival already is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.scoring import composite_risk
from tradewind.operators.scorecards import grid_km

#: Cell sizes in degrees: a point that no place is near enough for goes on to the next, the last covers the globe.
CELL_DEGREES = (2.0, 8.0, 32.0, 360.0)
KM_PER_NAUTICAL_MILE = 1.852
#: An arrival so many hours late counts as surely delayed.
CERTAIN_DELAY_HOURS = 72.0
MICROS_PER_HOUR = 3_600_000_000.0


def _degrees_apart(lat: Column, lon: Column, place: Column) -> Column:
    return F.abs(lat - place["lat"]) + F.abs(lon - place["lon"])


def with_nearest(points: DataFrame, places: DataFrame, latitude: Column, longitude: Column, name: str, cells: tuple[float, ...] = CELL_DEGREES) -> DataFrame:
    """``points`` with ``name``, the struct (id, label, lat, lon) of the place fewest degrees away; ties to the smaller id.

    ``places`` (id, label, lat, lon) is a dimension.  Each place is listed in its grid cell and the eight around it,
    and a point looks at the one list of its own cell: whatever is not on it is more than a
    cell's side away, so a place within that distance is surely the nearest.  Points without one look again in coarser
    grids.  A point meets the places of nine cells, not all; its row never moves but to its cell's list.
    NULL coordinates have no nearest place, and places with one are left out.
    """
    known = places.filter("lat IS NOT NULL AND lon IS NOT NULL")
    place = F.struct("id", "label", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    lat, lon = latitude.cast("double"), longitude.cast("double")
    found = points.withColumn(name, F.lit(None).cast("struct<id:string,label:string,lat:double,lon:double>"))
    for side in cells:
        x, y = F.floor(F.col("lat") / side), F.floor(F.col("lon") / side)
        nine = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
        lists = known.select(place.alias("place"), x.alias("x"), y.alias("y"), nine.alias("at"))
        lists = lists.select("place", (F.col("x") + F.col("at.i")).alias("_x"), (F.col("y") + F.col("at.j")).alias("_y"))
        lists = lists.groupBy("_x", "_y").agg(F.collect_list("place").alias("_near"))
        # A point that is settled, or has no coordinates, asks for no cell.
        open_ = F.col(name).isNull()
        asked = found.withColumns({"_px": F.when(open_, F.floor(lat / side)), "_py": F.when(open_, F.floor(lon / side))})
        met = asked.join(lists, (F.col("_px") == F.col("_x")) & (F.col("_py") == F.col("_y")), "left")
        ranked = F.array_min(F.transform("_near", lambda p: F.struct(_degrees_apart(lat, lon, p).alias("d"), p["id"].alias("id"), p.alias("p"))))
        near = met.withColumn("_best", ranked)
        sure = (F.col("_best.d") <= side) | F.lit(side == cells[-1])
        found = near.withColumn(name, F.coalesce(F.col(name), F.when(sure, F.col("_best.p")))).select(*points.columns, name)
    return found


def lane_delays(shipments: DataFrame) -> DataFrame:
    """lane_carrier, lane_mode and the share of late shipments of each."""
    late = F.count_if("is_delayed").cast("double") / F.count("*").cast("double")
    return shipments.groupBy(F.col("carrier").alias("lane_carrier"), F.col("mode").alias("lane_mode")).agg(late.alias("lane_late"))


def _hundredths(x: Column) -> Column:
    return F.floor(x * 100.0 + 0.5).cast("double") / 100.0


def entity_objects(states: DataFrame, plans: DataFrame, lanes: DataFrame, warehouses: DataFrame) -> DataFrame:
    """The state object of each entity in ``states`` (see ``entity_state``).

    ``plans`` (entity_id, destination_id, carrier, mode, promised_at) says where a shipment is going, ``lanes`` are ``lane_delays``,
    ``warehouses`` are both ends and the cities.  An entity without a plan, a destination or a speed has
    no arrival of its own and takes the promised one; one that was delivered has arrived when it was last seen.
    """
    ends = warehouses.select("warehouse_id", F.col("latitude").cast("double").alias("end_lat"), F.col("longitude").cast("double").alias("end_lon"))
    joined = states.join(plans, "entity_id", "left")
    joined = joined.join(ends, F.col("destination_id") == F.col("warehouse_id"), "left")
    joined = joined.join(lanes, (F.col("carrier") == F.col("lane_carrier")) & (F.col("mode") == F.col("lane_mode")), "left")
    cities = warehouses.select(F.col("warehouse_id").alias("id"), F.col("city").alias("label"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    here = (F.col("current_location.latitude"), F.col("current_location.longitude"))
    placed = with_nearest(joined, cities, *here, "hub")
    hours = grid_km(*here, F.col("end_lat"), F.col("end_lon")) / (F.col("speed").cast("double") * KM_PER_NAUTICAL_MILE)
    sailing = F.timestamp_micros(F.unix_micros("updated_at") + F.floor(hours * 3600.0).cast("bigint") * 1_000_000)
    eta = (
        F.when(F.col("status") == "DELIVERED", F.col("updated_at"))
        .when((F.col("speed") > 0) & F.col("end_lat").isNotNull() & F.col("end_lon").isNotNull(), sailing)
        .otherwise(F.col("promised_at"))
    )
    placed = placed.withColumn("eta", eta)
    behind = F.greatest(F.lit(0.0), (F.unix_micros("eta") - F.unix_micros("promised_at")).cast("double") / MICROS_PER_HOUR)
    certain = F.coalesce(F.least(F.lit(1.0), behind / CERTAIN_DELAY_HOURS), F.lit(0.0))
    lane = F.coalesce("lane_late", F.lit(0.0))
    delay = F.when(F.col("status") == "DELIVERED", F.lit(0.0)).otherwise(_hundredths(1.0 - (1.0 - lane) * (1.0 - certain)))
    placed = placed.withColumn("delay_probability", delay)
    risk = composite_risk({"transportation": F.col("delay_probability") * 100.0})
    return placed.withColumns(risk).select(
        "entity_type",
        "entity_id",
        F.struct("current_location.latitude", "current_location.longitude", F.col("hub.label").alias("city")).alias("current_location"),
        "status",
        F.col("speed").alias("speed_knots"),
        "eta",
        "delay_probability",
        F.col("composite_risk_score").alias("risk_score"),
        "risk_level",
        "cold_chain_status",
        "updated_at",
    )
