"""Every query the driver can run: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bikeflow.functions.clock import local_to_utc, span
from bikeflow.functions.geo import area_km2, distance_m, geodesic_m, point_wkt, snap, spheroid_km2, web_mercator
from bikeflow.functions.numbers import half_up, unit_draw
from bikeflow.operators import aggregates as agg
from bikeflow.operators import allocation as alloc
from bikeflow.operators import clusters as clus
from bikeflow.operators import dimension as dimn
from bikeflow.operators import events as ev
from bikeflow.operators import latest as lat
from bikeflow.operators import proximity as prox
from bikeflow.operators import quality as qual
from bikeflow.operators import regions as reg
from bikeflow.plans.runtime import scratch
from bikeflow.sources import archive, feeds, geojson, places, views
from bikeflow.sources.schemas import EVENTS
from bikeflow.streaming import departures as sdep
from bikeflow.streaming import landing as sland
from bikeflow.streaming import replica as srep
from bikeflow.streaming.mergelog import MergeLog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The driver's status rows are hours apart where a live feed has a minute, so
# windows and gaps are bound wider than the operators' defaults.
MAX_GAP_S = 43200
OD_HOURS = 24 * 365
TRIP_DAYS = 90
RECENT_HOURS = 48
SINCE = "2024-01-15 00:00:00"
LOOKBACK_S = 86400
# A rectangle over the network whose south side goes up to a point in its middle.
NETWORK_RING = [(-74.045, 40.605), (-73.95, 40.65), (-73.82, 40.605), (-73.82, 40.83), (-74.045, 40.83)]


def query(fn: Query) -> Query:
    """Register ``fn`` under its name; instants leave as zone-less UTC."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = fn(spark, sf_dir)
        return df.select(
            *[
                F.col(f.name).cast("timestamp_ntz").alias(f.name)
                if isinstance(f.dataType, T.TimestampType)
                else F.col(f.name)
                for f in df.schema.fields
            ]
        )

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def _features(df: DataFrame, geometry: Column, props: list, order: list[str], coordinates: str, kinds: str) -> DataFrame:
    """``df`` written as one GeoJSON document, and its features as rows."""
    spark = df.sparkSession
    folder = scratch(spark, "features")
    geojson.write_feature_collection(df, geometry, props, order, folder)
    feature = f"struct<geometry:struct<coordinates:{coordinates}>,properties:struct<{kinds}>>"
    return geojson.read_feature_collection(spark, folder).select(F.from_json("json", feature).alias("f"))


def _as_of(df: DataFrame, ts: str):
    return df.select(F.max(ts)).scalar()


# ---- feeds, ingestion and the dimension ----------------------------------------


@query
def parse_status(spark, d):
    return feeds.parse_status(views.status_docs(spark, d))


@query
def parse_stations(spark, d):
    return feeds.parse_stations(views.station_docs(spark, d))


@query
def feed_catalog(spark, d):
    return feeds.feed_catalog(views.discovery_docs(spark, d))


@query
def feed_lookup(spark, d):
    return feeds.feed_catalog(views.discovery_docs(spark, d), "station_status")


@query
def landing_collapsed(spark, d):
    return dimn.collapse_landing(feeds.parse_status(views.status_docs(spark, d)))


@query
def assign_keys(spark, d):
    return dimn.assign_keys(views.stations(spark, d), views.incoming_stations(spark, d))


@query
def replace_stations(spark, d):
    return archive.replace_stations(views.station_docs(spark, d), scratch(spark, "stations"))


@query
def upsert_stations(spark, d):
    return dimn.upsert_stations(views.stations(spark, d), views.incoming_stations(spark, d))


@query
def incremental_load(spark, d):
    fact = views.status(spark, d).filter(F.col("polled_at") <= F.lit(SINCE).cast("timestamp"))
    landing = feeds.parse_status(views.status_docs(spark, d))
    return dimn.incremental_load(fact, landing, views.stations(spark, d))


@query
def incremental_load_logged(spark, d):
    """The same load against facts kept as a log: the mark comes from its manifest."""
    target = sland.SyncTarget(spark, scratch(spark, "facts"))
    facts = views.status(spark, d).filter(F.col("polled_at") <= F.lit(SINCE).cast("timestamp"))
    target.fact_log.append(facts, 0)
    landing = feeds.parse_status(views.status_docs(spark, d))
    return dimn.incremental_load(target.fact_log.newest(), landing, views.stations(spark, d))


@query
def unmatched_landing(spark, d):
    fact = views.status(spark, d).filter(F.col("polled_at") <= F.lit(SINCE).cast("timestamp"))
    landing = feeds.parse_status(views.status_docs(spark, d))
    known = views.stations(spark, d).filter(F.col("capacity").isNotNull())
    return dimn.unmatched_landing(fact, landing, known)


@query
def apply_cdc(spark, d):
    base = views.stations(spark, d).select("station_key", "name", "capacity")
    return dimn.apply_cdc(base, views.changes(spark, d))


@query
def retain_trips(spark, d):
    trips = views.trips(spark, d)
    kept = dimn.retain(trips, "started_at", 180, _as_of(trips, "started_at"))
    return kept.groupBy("source").agg(
        F.count(F.lit(1)).alias("trips"), F.min("started_at").alias("oldest")
    )


@query
def retain_landing(spark, d):
    landing = feeds.parse_status(views.status_docs(spark, d))
    kept = dimn.retain(landing, "polled_at", 10, _as_of(landing, "polled_at"))
    return kept.groupBy(F.to_date("polled_at").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("rows"))


@query
def retain_logged(spark, d):
    """Retention on storage: the landing rows as a log by day, whose old days go by folder."""
    log = MergeLog(spark, scratch(spark, "landing-log"), sland.WAITING, ("station_id", "polled_at"), "polled_at")
    log.append(feeds.parse_status(views.status_docs(spark, d)), 0)
    newest = log.newest()
    if newest:
        log.drop_before(newest - dt.timedelta(days=10), 1)
    return log.read().groupBy(F.to_date("polled_at").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("rows"))


@query
def trip_archive(spark, d):
    """Trips written in the column order of published archives, and read back by name."""
    st = views.stations(spark, d)
    path = scratch(spark, "trip-archive")

    def end(side: str) -> DataFrame:
        return st.select(
            F.col("station_key").alias(f"{side}_station_key"), F.col("name").alias(f"{side}_station_name"),
            F.col("lat").alias(f"{side}_lat"), F.col("lon").alias(f"{side}_lng"),
        )

    def station_id(side: str) -> Column:
        return F.concat(F.lit("S"), F.col(f"{side}_station_key").cast("string")).alias(f"{side}_station_id")

    trips = views.trips(spark, d).join(end("start"), "start_station_key", "left").join(end("end"), "end_station_key", "left")
    trips.select(
        F.md5(F.concat_ws("|", "started_at", "start_station_key", "end_station_key", "meters")).alias("ride_id"),
        "rideable_type",
        F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started_at"),
        F.date_format("ended_at", "yyyy-MM-dd HH:mm:ss").alias("ended_at"),
        "start_station_name", station_id("start"), "end_station_name", station_id("end"),
        "start_lat", "start_lng", "end_lat", "end_lng", "member_casual",
    ).write.option("header", True).option("compression", "gzip").csv(path)
    return archive.read_trip_csv(spark, path).groupBy("member_casual").agg(
        F.count(F.lit(1)).alias("trips"),
        F.min("started_at").alias("first"),
        F.max("ended_at").alias("last"),
        F.count_distinct("start_station_id").alias("origins"),
        F.count_distinct("end_station_id").alias("destinations"),
        F.count("end_lat").alias("placed"),
        F.min("start_lat").alias("south"),
        F.max("end_lng").alias("east"),
    )


@query
def document_summary(spark, d):
    """Status documents, every seventh hour's cut off in the middle."""
    docs = views.status_docs(spark, d)
    hour = F.call_function("div", F.get_json_object("json", "$.last_updated").cast("bigint"), F.lit(3600))
    half = F.substring("json", F.lit(1), F.length("json") - 2)
    return feeds.document_summary(docs.select(F.when(hour % 7 == 0, half).otherwise(F.col("json")).alias("json")))


@query
def landing_summary(spark, d):
    return dimn.landing_summary(feeds.parse_status(views.status_docs(spark, d)))


@query
def station_features(spark, d):
    """The live map as GeoJSON, read back to rows."""
    live = lat.station_map(views.status(spark, d), views.stations(spark, d))
    made = _features(
        live, geojson.point_geometry(F.col("lon"), F.col("lat")),
        ["name", "capacity", "bikes", "ebikes", "docks"], ["station_key"],
        "array<double>", "name:string,capacity:int,bikes:int,ebikes:int,docks:int",
    )
    at = F.col("f.geometry.coordinates")
    return made.select("f.properties.*", at[0].alias("lon"), at[1].alias("lat"))


# ---- latest state, snapshots and summaries --------------------------------------


@query
def latest_state(spark, d):
    return lat.latest_per(
        views.status(spark, d), "station_key", "polled_at", "status_id",
        ["polled_at", "num_bikes_available", "num_docks_available"],
    )


@query
def newest_snapshot(spark, d):
    return lat.newest_snapshot(views.status(spark, d))


@query
def dim_profile(spark, d):
    return lat.dim_profile(views.stations(spark, d))


@query
def fact_profile(spark, d):
    """The facts of stations that take no bikes back, at the newest snapshot of all."""
    status = views.status(spark, d)
    return lat.fact_profile(status.filter(~F.col("is_returning")), _as_of(status, "polled_at"))


@query
def fact_profile_whole(spark, d):
    """All facts, at the newest trip."""
    return lat.fact_profile(views.status(spark, d), _as_of(views.trips(spark, d), "started_at"))


@query
def recent_polls(spark, d):
    return lat.recent_polls(views.status(spark, d))


@query
def empty_now(spark, d):
    return lat.empty_now(views.status(spark, d), views.stations(spark, d))


@query
def station_map(spark, d):
    return lat.station_map(views.status(spark, d), views.stations(spark, d))


@query
def trip_summary(spark, d):
    return lat.trip_summary(views.trips(spark, d))


# ---- aggregates -----------------------------------------------------------------


@query
def system_pulse(spark, d):
    return agg.system_pulse(views.status(spark, d))


@query
def fleet_by_hour(spark, d):
    return agg.fleet_by_hour(views.status(spark, d))


@query
def busiest_stations(spark, d):
    return agg.busiest(views.status(spark, d), views.stations(spark, d))


@query
def stranding_rate(spark, d):
    return agg.stranding(views.status(spark, d), views.stations(spark, d))


@query
def ebike_share(spark, d):
    return agg.ebike_share(views.status(spark, d))


@query
def out_of_service(spark, d):
    return agg.out_of_service(views.status(spark, d))


@query
def stranding_pressure(spark, d):
    return agg.pressure(views.status(spark, d), views.stations(spark, d))


@query
def pressure_features(spark, d):
    """The map of empty and full stations as GeoJSON, read back to rows."""
    made = _features(
        agg.pressure(views.status(spark, d), views.stations(spark, d)),
        geojson.point_geometry(F.col("lon"), F.col("lat")),
        ["name", "observations", "pct_no_bikes", "pct_no_docks", "net"], ["station_key"],
        "array<double>", "name:string,observations:bigint,pct_no_bikes:double,pct_no_docks:double,net:double",
    )
    at = F.col("f.geometry.coordinates")
    return made.select("f.properties.*", at[0].alias("lon"), at[1].alias("lat"))


@query
def trip_hours(spark, d):
    return agg.trip_hours(views.trips(spark, d))


@query
def trip_pairs(spark, d):
    return agg.trip_pairs(views.trips(spark, d), views.stations(spark, d))


@query
def rider_mix(spark, d):
    return agg.rider_mix(views.trips(spark, d))


@query
def od_pairs(spark, d):
    trips = views.trips(spark, d)
    return agg.od_pairs(trips, _as_of(trips, "started_at"), hours=OD_HOURS)


@query
def ingest_buckets(spark, d):
    status = views.status(spark, d)
    return agg.ingest_buckets(status, _as_of(status, "polled_at"), hours=RECENT_HOURS)


@query
def system_level(spark, d):
    status = views.status(spark, d)
    return agg.system_level(status, _as_of(status, "polled_at"), hours=RECENT_HOURS)


@query
def fleet_hour_spine(spark, d):
    return agg.fleet_hour_spine(views.status(spark, d))


@query
def dry_distribution(spark, d):
    return agg.dry_distribution(views.status(spark, d))


@query
def weekday_weekend(spark, d):
    trips = views.trips(spark, d)
    return agg.weekday_weekend(trips, _as_of(trips, "started_at"), days=TRIP_DAYS)


@query
def weekday_weekend_all(spark, d):
    """The whole history, so that both sides of the DST change take part."""
    trips = views.trips(spark, d)
    return agg.weekday_weekend(trips, _as_of(trips, "started_at"), days=36500)


@query
def duration_hist(spark, d):
    trips = views.trips(spark, d)
    return agg.duration_hist(trips, _as_of(trips, "started_at"), days=TRIP_DAYS)


@query
def hour_rollup(spark, d):
    return agg.hour_rollup(views.status(spark, d))


@query
def count_snapshots(spark, d):
    return agg.count_all(views.status(spark, d))


@query
def observations_by_station(spark, d):
    return agg.observations_by_station(views.status(spark, d), views.stations(spark, d))


@query
def log_summary(spark, d):
    status = views.status(spark, d)
    return agg.log_summary(
        status.select(
            F.when(F.col("event_type") == "view", "map").otherwise("agg").alias("kind"),
            F.when(F.col("event_type") == "click", "remote").otherwise("local").alias("engine"),
            F.col("value").alias("ms"),
            F.when(F.col("k") % 2 == 0, F.col("k")).alias("crossed"),
        )
    )


# ---- snapshots to events --------------------------------------------------------


@query
def snapshot_deltas(spark, d):
    return ev.snapshot_deltas(views.status(spark, d)).select(
        "station_key", "polled_at", "delta", "gap_seconds"
    )


@query
def hourly_flows(spark, d):
    return ev.hourly_flows(views.status(spark, d), max_gap=MAX_GAP_S)


@query
def station_flows(spark, d):
    return ev.station_flows(views.status(spark, d), views.stations(spark, d), max_gap=MAX_GAP_S)


@query
def total_departures(spark, d):
    return ev.total_departures(views.status(spark, d))


@query
def delta_listing(spark, d):
    return ev.delta_listing(views.status(spark, d))


@query
def delta_by_level(spark, d):
    return ev.delta_by_level(views.status(spark, d))


@query
def flow_balance(spark, d):
    return ev.flow_balance(views.status(spark, d))


@query
def departures(spark, d):
    return ev.departures(views.status(spark, d), SINCE, lookback_s=LOOKBACK_S)


@query
def departing_bikes(spark, d):
    left = ev.departures(views.status(spark, d), SINCE, lookback_s=LOOKBACK_S)
    return ev.explode_count(left).select("station_key", "polled_at", "unit")


@query
def thinned_departures(spark, d):
    left = ev.explode_count(ev.departures(views.status(spark, d)))
    return ev.thin(left, ["status_id", "unit"]).select("station_key", "status_id", "unit")


# ---- data quality and reconciliation ---------------------------------------------


@query
def duplicate_status(spark, d):
    landing = feeds.parse_status(views.status_docs(spark, d))
    return qual.duplicates(landing, ["station_id", "polled_at"])


@query
def orphan_facts(spark, d):
    known = views.stations(spark, d).filter(F.col("capacity").isNotNull())
    return qual.orphans(views.status(spark, d), known)


@query
def freshness(spark, d):
    """Age of the newest snapshot of a station that does not rent, at the newest snapshot of all."""
    status = views.status(spark, d)
    return qual.freshness(status.filter(~F.col("is_renting")), _as_of(status, "polled_at"))


@query
def freshness_whole(spark, d):
    """The age of all facts at the newest trip."""
    return qual.freshness(views.status(spark, d), _as_of(views.trips(spark, d), "started_at"))


@query
def reconcile_counts(spark, d):
    status = views.status(spark, d)
    landing = dimn.collapse_landing(feeds.parse_status(views.status_docs(spark, d)))
    return qual.reconcile_counts(status, landing, ("fact", "landing"))


@query
def reconcile_rows(spark, d):
    base = views.stations(spark, d).select("station_key", "name", "capacity")
    return qual.reconcile_rows(base, dimn.apply_cdc(base, views.changes(spark, d)))


@query
def reconcile_tree(spark, d):
    """Facts against a copy in which some levels were changed, some rows lost and some doubled."""
    facts = views.status(spark, d).select("status_id", "station_key", "polled_at", "num_bikes_available")
    n = F.col("status_id")
    level = F.when(n % 997 == 0, F.col("num_bikes_available") + 1).otherwise(F.col("num_bikes_available"))
    copy = facts.filter(n % 1009 != 5).withColumn("num_bikes_available", level)
    copy = copy.unionByName(copy.filter(n % 1013 == 7))
    return qual.reconcile_tree(facts, copy)


@query
def check_report(spark, d):
    status, st = views.status(spark, d), views.stations(spark, d)

    def none_of(rows: DataFrame, what: str) -> DataFrame:
        n = F.count(F.lit(1))
        return rows.agg((n == 0).alias("ok"), F.concat(n.cast("string"), F.lit(" " + what)).alias("detail"))

    def fresh() -> DataFrame:
        seen = qual.freshness(status, _as_of(views.trips(spark, d), "started_at"))
        return seen.select("ok", F.concat(F.col("seconds_old").cast("string"), F.lit(" s old")).alias("detail"))

    return qual.run_checks(
        spark,
        [
            qual.Check("no duplicate snapshots", lambda: none_of(
                qual.duplicates(status, ["station_key", "polled_at"]), "duplicated"), "collapse the landing rows"),
            qual.Check("no orphan facts", lambda: none_of(
                qual.orphans(status, st), "orphans"), "load the dimension first"),
            qual.Check("data is arriving", fresh, "look at the poller"),
            qual.Check("every capacity known", lambda: none_of(
                st.filter(F.col("capacity").isNull()), "without capacity"), "fill the station list"),
        ],
    )


@query
def poll_gaps(spark, d):
    return qual.poll_gaps(views.status(spark, d), limit_s=1800)


# ---- spatial ----------------------------------------------------------------------

PLACE = (-74.0, 40.65)
WIDTH = 0.004


def _diamonds(spark, d):
    """A diamond of half-width ``WIDTH`` degrees around every station."""
    corners = [(WIDTH, 0.0), (0.0, WIDTH), (-WIDTH, 0.0), (0.0, -WIDTH)]
    ring = F.array(
        *[F.struct((F.col("lon") + a).alias("lon"), (F.col("lat") + b).alias("lat")) for a, b in corners]
    )
    return views.stations(spark, d).select(F.col("station_key").alias("polygon_id"), ring.alias("ring"))


@query
def point_columns(spark, d):
    rows = dimn.with_point(views.incoming_stations(spark, d))
    lon, lat_ = F.col("geom.lon"), F.col("geom.lat")
    x, y = web_mercator(lon, lat_)
    return rows.select(
        "station_id",
        point_wkt(snap(lon, 0.0001), snap(lat_, 0.0001)).alias("wkt"),
        F.round(x, 3).alias("x"),
        F.round(y, 3).alias("y"),
    )


@query
def trip_distances(spark, d):
    """Great-circle length of every pair of stations that trips connect."""
    pairs = views.trips(spark, d).groupBy("start_station_key", "end_station_key").agg(
        F.count(F.lit(1)).alias("trips")
    )
    st = views.stations(spark, d)
    a = st.select(F.col("station_key").alias("start_station_key"), F.col("lon").alias("x1"), F.col("lat").alias("y1"))
    b = st.select(F.col("station_key").alias("end_station_key"), F.col("lon").alias("x2"), F.col("lat").alias("y2"))
    metres = distance_m(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    return pairs.join(a, "start_station_key").join(b, "end_station_key").select(
        "start_station_key", "end_station_key", "trips", half_up(metres, 3).alias("metres")
    )


@query
def nearest_to_largest(spark, d):
    return prox.nearest_to(views.stations(spark, d))


@query
def knn_join(spark, d):
    return prox.knn_join(views.stations(spark, d)).withColumn("meters", half_up(F.col("meters"), 3))


@query
def knn_join_metres(spark, d):
    near = prox.knn_join(views.stations(spark, d), k=10, order_by="metres")
    return near.withColumn("meters", half_up(F.col("meters"), 3))


@query
def within_radius(spark, d):
    return prox.within_radius(views.stations(spark, d), *PLACE, 2000).select("station_key", "name")


@query
def radius_agg(spark, d):
    return prox.radius_agg(views.status(spark, d), views.stations(spark, d), *PLACE, 5000)


@query
def within_radius_placed(spark, d):
    """The same over stations laid out by place."""
    path = scratch(spark, "stations-by-place")
    places.write_by_place(views.stations(spark, d), path)
    return places.within_radius(spark, path, *PLACE, 2000).select("station_key", "name")


@query
def radius_agg_placed(spark, d):
    """The same over facts and stations laid out by place."""
    st, facts = scratch(spark, "stations-by-place"), scratch(spark, "facts-by-place")
    places.write_by_place(views.stations(spark, d), st)
    places.write_facts_by_place(views.status(spark, d), views.stations(spark, d), facts)
    return places.radius_agg(spark, facts, st, *PLACE, 5000)


@query
def agg_by_keys(spark, d):
    keys = views.stations(spark, d).filter(F.col("capacity") >= 40)
    return prox.agg_by_keys(views.status(spark, d), keys)


@query
def convex_hull(spark, d):
    """The hull as numbered corners."""
    return reg.convex_hull(views.stations(spark, d)).select(F.posexplode("ring").alias("i", "p")).select("i", "p.*")


@query
def polygon_areas(spark, d):
    return _diamonds(spark, d).select("polygon_id", half_up(area_km2(F.col("ring")), 6).alias("km2"))


@query
def polygon_areas_spheroid(spark, d):
    return _diamonds(spark, d).select("polygon_id", half_up(spheroid_km2(F.col("ring")), 6).alias("km2"))


@query
def network_density(spark, d):
    return reg.network_density(views.stations(spark, d))


@query
def density_clusters(spark, d):
    return clus.dbscan(views.stations(spark, d))


@query
def cluster_sizes(spark, d):
    return clus.cluster_sizes(clus.dbscan(views.stations(spark, d)))


@query
def service_areas(spark, d):
    return reg.service_areas(views.stations(spark, d))


@query
def service_area_features(spark, d):
    """The map of service areas as GeoJSON, read back to rows."""
    areas = reg.service_areas(views.stations(spark, d), n=None, drop_empty=True)
    made = _features(
        areas, geojson.polygon_geometry(F.col("ring")), ["name", "capacity", F.col("service_km2").alias("km2")], ["station_key"],
        "array<array<array<double>>>", "name:string,capacity:int,km2:double",
    )
    return made.select("f.properties.*")


@query
def service_grid(spark, d):
    return prox.service_grid(views.stations(spark, d)).withColumn("km2", half_up(F.col("km2"), 6))


@query
def points_in_polygons(spark, d):
    return prox.points_in_polygons(views.stations(spark, d), _diamonds(spark, d))


@query
def polygon_cover(spark, d):
    """The diamonds and one polygon over most of the network, with a notch: stations inside each."""
    x, y = (F.array(*[F.lit(v) for v in c]) for c in zip(*NETWORK_RING, strict=True))
    wide = views.stations(spark, d).limit(1).select(
        F.lit(-1).cast("bigint").alias("polygon_id"),
        F.arrays_zip(x.alias("lon"), y.alias("lat")).alias("ring"),
    )
    polygons = _diamonds(spark, d).unionByName(wide)
    return prox.points_in_polygons(views.stations(spark, d), polygons)


def _flows(spark, d):
    trips = views.trips(spark, d)
    od = agg.od_pairs(trips, _as_of(trips, "started_at"), hours=OD_HOURS)
    return prox.flow_lines(od, views.stations(spark, d))


@query
def flow_geodesics(spark, d):
    """Lengths of the flow lines on the spheroid, in metres."""
    ends = [F.col("line")[i][c] for i in (0, 1) for c in ("lon", "lat")]
    return _flows(spark, d).select("start_station_key", "end_station_key", half_up(geodesic_m(*ends), 3).alias("metres"))


@query
def flow_lines(spark, d):
    line = F.col("line")
    return _flows(spark, d).select(
        "start_station_key", "end_station_key", "from_name", "to_name", "trips", "km",
        line[0]["lon"].alias("from_lon"), line[0]["lat"].alias("from_lat"),
        line[1]["lon"].alias("to_lon"), line[1]["lat"].alias("to_lat"),
    )


@query
def flow_features(spark, d):
    """The flow map as GeoJSON, read back to rows."""
    ends = [(F.col("line")[i]["lon"], F.col("line")[i]["lat"]) for i in (0, 1)]
    made = _features(
        _flows(spark, d).withColumnsRenamed({"from_name": "from", "to_name": "to"}),
        geojson.line_geometry(*ends), ["from", "to", "trips", "km"],
        ["start_station_key", "end_station_key"],
        "array<array<double>>", "from:string,to:string,trips:bigint,km:double",
    )
    at = F.col("f.geometry.coordinates")
    return made.select(
        F.col("f.properties.from").alias("from_name"), F.col("f.properties.to").alias("to_name"),
        "f.properties.trips", "f.properties.km",
        at[0][0].alias("from_lon"), at[0][1].alias("from_lat"), at[1][0].alias("to_lon"), at[1][1].alias("to_lat"),
    )


# ---- weighted choice and profiles ---------------------------------------------------


def _rounded_pool(pool: DataFrame) -> DataFrame:
    return pool.select(
        "start_station_key", "end_station_key",
        *[half_up(F.col(c), p).alias(c) for c, p in (("meters", 3), ("w_lo", 9), ("w_hi", 9))],
    )


@query
def decay_pool(spark, d):
    return _rounded_pool(alloc.decay_pool(views.stations(spark, d)))


@query
def capacity_cdf(spark, d):
    return alloc.capacity_cdf(views.stations(spark, d))


@query
def origin_draws(spark, d):
    """Every status row draws a station by capacity: the keyless bucket lookup."""
    rows = views.status(spark, d).select("status_id").withColumn("u", unit_draw(F.lit("origin"), "status_id"))
    return alloc.bucket_join(rows, "u", alloc.capacity_cdf(views.stations(spark, d))).select(
        "status_id", "station_key"
    )


@query
def expected_od(spark, d):
    pool = alloc.decay_pool(views.stations(spark, d))
    flows = alloc.expected_od(ev.departures(views.status(spark, d)), pool)
    return flows.withColumn("expected", half_up(F.col("expected"), 6))


@query
def trip_attributes(spark, d):
    return alloc.trip_attributes(views.trips(spark, d))


@query
def observed_trips(spark, d):
    return alloc.observed_trips(views.status(spark, d), views.trips(spark, d))


@query
def hour_profile(spark, d):
    return alloc.hour_profile(views.trips(spark, d)).withColumn("share", half_up(F.col("share"), 9))


@query
def apportion(spark, d):
    hours = alloc.apportion(views.trips(spark, d)).withColumn("expected", half_up(F.col("expected"), 6))
    return hours.withColumn("day", F.col("day").cast("string"))


@query
def local_instants(spark, d):
    """Trip starts read as New York wall-clock time, per UTC hour."""
    instants = local_to_utc(F.col("started_at"), "America/New_York")
    return views.trips(spark, d).groupBy(F.date_trunc("hour", instants).alias("hour")).agg(
        F.count(F.lit(1)).alias("trips")
    )


# ---- streaming: each job runs once over the available files ---------------------------


def _landed_documents(spark, d, files: int | None = None) -> DataFrame:
    """The status documents as files, and a stream over them.

    With ``files`` they are dealt out by hash, so that times are mixed, and each file is a batch of its own.
    """
    path = scratch(spark, "documents")
    docs = views.status_docs(spark, d)
    (docs.repartition(files, docs.columns[0]) if files else docs).write.text(path)
    return sland.read_documents(spark, path, files_per_trigger=1 if files else 1000, one_per_file=False)


def _in_slices(spark, d, start: Callable[[DataFrame], StreamingQuery], slices: int = 5) -> None:
    """Land the status rows in slices of time and run the job after each: it resumes from its checkpoint."""
    events = spark.read.schema(EVENTS).parquet(f"{d}/events.parquet")
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    ends = [str(lo + (hi - lo) * i / slices) for i in range(1, slices)] if lo else []
    passed = [F.coalesce(F.col("ts") >= F.lit(e).cast("timestamp_ntz"), F.lit(False)).cast("int") for e in ends]
    nth = sum(passed, F.lit(0))
    path = scratch(spark, "events")
    for i in range(len(ends) + 1):
        events.filter(nth == i).write.mode("append").parquet(path)
        start(views.status_of(spark.readStream.schema(EVENTS).parquet(path))).awaitTermination()


@query
def stream_landing(spark, d):
    sink = scratch(spark, "landing")
    sland.stream_append_status(
        _landed_documents(spark, d), sink, scratch(spark, "landing-state")
    ).awaitTermination()
    return sland.read_landing(spark, sink)


@query
def stream_sync(spark, d):
    target = sland.SyncTarget(spark, scratch(spark, "sync"))
    sland.stream_sync(
        _landed_documents(spark, d, files=8), lambda: views.stations(spark, d).drop("station_key"),
        target, scratch(spark, "sync-state"), sland.ONCE,
    ).awaitTermination()
    return target.facts().join(target.stations().select("station_key", "station_id"), "station_key").select(
        "station_id", "polled_at", "last_reported", "num_bikes_available", "is_renting", "is_returning"
    )


@query
def stream_poll_totals(spark, d):
    sink, state = scratch(spark, "poll-totals"), scratch(spark, "poll-state")
    _in_slices(spark, d, lambda status: sland.stream_poll_totals(status, sink, state))
    return sland.read_poll_totals(spark, sink)


@query
def stream_hour_rollup(spark, d):
    sink, state = scratch(spark, "rollups"), scratch(spark, "rollup-state")
    _in_slices(spark, d, lambda status: sland.stream_rollups(status, sink, state))
    return sland.read_rollup(spark, sink, "hour", 24)


@query
def stream_cdc(spark, d):
    """Change rows in batches that mix all versions."""
    base = views.stations(spark, d).select("station_key", "name", "capacity")
    log = srep.replica_log(spark, scratch(spark, "replica"), base, fan=3)
    srep.start_replica(log, base)
    path = scratch(spark, "changes")
    changes = views.changes(spark, d)
    changes.repartition(5, F.xxhash64("station_key", "ver")).write.parquet(path)
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(path)
    srep.stream_changes(stream, log, scratch(spark, "replica-state")).awaitTermination()
    return srep.read_replica(log)


@query
def stream_departures(spark, d):
    sink, state = scratch(spark, "departures"), scratch(spark, "departure-state")
    _in_slices(spark, d, lambda status: sdep.stream_departures(status, sink, state, LOOKBACK_S))
    return sdep.read_departures(spark, sink)


@query
def stream_departures_shuffled(spark, d):
    """The same with rows dealt over the batches at random: each batch repairs what the others left."""
    sink, state, path = scratch(spark, "departures"), scratch(spark, "departure-state"), scratch(spark, "events")
    events = spark.read.schema(EVENTS).parquet(f"{d}/events.parquet")
    events.repartition(4, F.xxhash64("event_id")).write.parquet(path)
    span_s = (F.unix_seconds(F.max("ts").cast("timestamp")) - F.unix_seconds(F.min("ts").cast("timestamp"))).alias("s")
    rows = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(path)
    lateness_s = events.agg(span_s).first().s or 0
    sdep.stream_departures(views.status_of(rows), sink, state, lateness_s + 1).awaitTermination()
    return sdep.read_departures(spark, sink)
