"""Query registry: one callable (spark, sf_dir) -> DataFrame per operator key.

Every key reads the test tables under ``sf_dir`` (through the adapter in
``sources.testdata``) and builds its stages lazily with ``Pipeline``, so the
work of each key grows with the data. Scopes are parameters: only the scope
filter and the dashboards use FOCUS and the minute day; all other keys cover
all days and stations.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tvpulse.functions.time import view_minutes
from tvpulse.ml import evaluate as ME
from tvpulse.ml import features as MF
from tvpulse.ml import explain as MX
from tvpulse.ml import jobs as MJ
from tvpulse.ml import model as MM
from tvpulse.operators import clean as C
from tvpulse.operators import metrics as K
from tvpulse.operators import intervals as I
from tvpulse.operators import predictions as P
from tvpulse.operators import quality as Q
from tvpulse.operators import search as SR
from tvpulse.operators.sweep import minute_audience_sweep
from tvpulse.plans import build as B
from tvpulse.plans import dashboards as D
from tvpulse.plans import semantic as S
from tvpulse.plans.pipeline import Pipeline
from tvpulse.plans.scope import Scope
from tvpulse.schemas import (CLEAN_COLUMNS, DAILY_KEYS, DATASET_VERSION, DEVICE_LABELS, GENRES, NETWORKS, PROGRAM_MASTER,
                             PROGRAM_SCHEDULE, VIEWING_LOG)
from tvpulse.session import output_dir
from tvpulse.sources import faults, readers, testdata
from tvpulse.sources.history import LoadHistory
from tvpulse.streaming.ingest import load_once

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


# ---- 2.1 sources ---------------------------------------------------------------

@query("src_viewing_log")
def q_src_viewing_log(spark, sf):
    """The typed reader on one station's folder of the deployed logs."""
    logs = readers.versioned(_deployed(spark, sf), DATASET_VERSION, "VIEWING_LOG")
    return readers.viewing_log(spark, logs, "NW01")


@query("src_device_labels")
def q_src_device_labels(spark, sf):
    return testdata.device_labels(spark, sf)


@query("src_program_master")
def q_src_program_master(spark, sf):
    return testdata.program_master(spark, sf)


@query("src_program_schedule")
def q_src_program_schedule(spark, sf):
    return testdata.program_schedule(spark, sf)


# ---- 2.2 cleaning --------------------------------------------------------------

@query("clean_viewing")
def q_clean_viewing(spark, sf):
    return Pipeline(spark, sf).clean


@query("valid_intervals_filter")
def q_valid_intervals(spark, sf):
    return C.valid_intervals_filter(Pipeline(spark, sf).raw)


@query("exact_dedup")
def q_exact_dedup(spark, sf):
    return C.exact_dedup(Pipeline(spark, sf).raw)


@query("genre_normalize")
def q_genre_normalize(spark, sf):
    raw = Pipeline(spark, sf).raw
    return C.genre_normalize(raw.select("EVENT_ID", "NETWORK_ID", "GENRE"))


@query("view_minutes")
def q_view_minutes(spark, sf):
    return C.valid_intervals_filter(Pipeline(spark, sf).raw).select(
        "EVENT_ID", "NETWORK_ID", "VIEW_FROM", "VIEW_TO", view_minutes().alias("VIEW_MINUTES"))


@query("rejects_report")
def q_rejects_report(spark, sf):
    return C.rejects_report(Pipeline(spark, sf).raw)


# ---- 2.3 / 2.5 / 2.7 marts -----------------------------------------------------

@query("device_daily")
def q_device_daily(spark, sf):
    return Pipeline(spark, sf).daily


def _stored_stations(p: Pipeline, mart: str) -> str:
    out = _new_folder(p.spark, "marts")
    B.store_stations(p.raw, out, marts=(mart,))
    return out


@query("common_viewing_daily")
def q_common_viewing_daily(spark, sf):
    """The union of five stored station marts."""
    return B.common_daily(spark, _stored_stations(Pipeline(spark, sf), "mart_device_daily"))


@query("viewing_minutes")
def q_viewing_minutes(spark, sf):
    return Pipeline(spark, sf).minutes


@query("minute_audience")
def q_minute_audience(spark, sf):
    return Pipeline(spark, sf).audience_exploded


@query("minute_audience_sweep")
def q_minute_audience_sweep(spark, sf):
    return minute_audience_sweep(C.valid_intervals_filter(Pipeline(spark, sf).raw))


@query("common_minute_audience")
def q_common_minute_audience(spark, sf):
    """The union of five stored station marts."""
    return B.common_audience(spark, _stored_stations(Pipeline(spark, sf), "mart_minute_audience"))


@query("kpi_network")
def q_kpi_network(spark, sf):
    return K.kpi(Pipeline(spark, sf).daily, "NETWORK_ID")


# ---- scopes of the dashboard queries; other keys cover every day and station
FOCUS = Scope.of("2024-01-15", "2024-01-28", ("NW01", "NW02", "NW04"))


def _whole_period(p: Pipeline) -> Scope:
    """First to last viewing date of the data (A9) and all stations; exact
    copies don't change it, so one scan of the valid rows is enough."""
    day = F.to_date("VIEW_FROM")
    return Scope.of(*C.valid_intervals_filter(p.raw).agg(F.min(day), F.max(day)).first())


MINUTE_DAY = "2024-01-15"
MINUTE_STATIONS = ("NW01", "NW03", "NW05")


@query("scope_filter")
def q_scope_filter(spark, sf):
    return FOCUS.apply(Pipeline(spark, sf).daily)


@query("kpi_summary")
def q_kpi_summary(spark, sf):
    return K.kpi(Pipeline(spark, sf).daily)


@query("kpi_daily")
def q_kpi_daily(spark, sf):
    return K.kpi(Pipeline(spark, sf).daily, "VIEW_DATE")


@query("kpi_genre")
def q_kpi_genre(spark, sf):
    return K.kpi(Pipeline(spark, sf).daily, "GENRE")


@query("kpi_network_genre")
def q_kpi_network_genre(spark, sf):
    return K.kpi(Pipeline(spark, sf).daily, "NETWORK_ID", "GENRE")


@query("minutes_per_device")
def q_minutes_per_device(spark, sf):
    return K.minutes_per_device(K.kpi(Pipeline(spark, sf).daily))


@query("network_share")
def q_network_share(spark, sf):
    return K.network_share(Pipeline(spark, sf).daily)


@query("date_bounds")
def q_date_bounds(spark, sf):
    p = Pipeline(spark, sf)
    return K.date_bounds(p.daily, p.audience)


@query("common_totals")
def q_common_totals(spark, sf):
    return K.common_totals(Pipeline(spark, sf).daily)


@query("minute_totals")
def q_minute_totals(spark, sf):
    return K.minute_totals(Pipeline(spark, sf).audience)


@query("conditional_sums")
def q_conditional_sums(spark, sf):
    return K.conditional_sums(Pipeline(spark, sf).daily)


@query("calendar_reindex")
def q_calendar_reindex(spark, sf):
    p = Pipeline(spark, sf)
    period = _whole_period(p)
    return K.calendar_reindex(K.kpi(p.daily, "VIEW_DATE"), period.start, period.end)


@query("reach_7d")
def q_reach_7d(spark, sf):
    return D.trend_series(Pipeline(spark, sf).daily)


@query("trend_unpivot")
def q_trend_unpivot(spark, sf):
    return D.trend_unpivot(Pipeline(spark, sf).daily)


@query("minute_series")
def q_minute_series(spark, sf):
    return D.minute_series(Pipeline(spark, sf).audience, MINUTE_DAY, MINUTE_STATIONS)


@query("minute_peaks")
def q_minute_peaks(spark, sf):
    return K.minute_peaks(D.minute_scope(Pipeline(spark, sf).audience, MINUTE_DAY, MINUTE_STATIONS))


@query("minute_top_peak")
def q_minute_top_peak(spark, sf):
    series = D.minute_scope(Pipeline(spark, sf).audience, MINUTE_DAY, MINUTE_STATIONS)
    return K.minute_top_peak(K.minute_peaks(series))


@query("minute_pivot")
def q_minute_pivot(spark, sf):
    return K.minute_pivot(D.minute_scope(Pipeline(spark, sf).audience, MINUTE_DAY, MINUTE_STATIONS))


@query("dash_summary")
def q_dash_summary(spark, sf):
    return D.dash_summary(Pipeline(spark, sf).daily, FOCUS)


@query("dash_trends")
def q_dash_trends(spark, sf):
    return D.dash_trends(Pipeline(spark, sf).daily, FOCUS)


@query("dash_minute")
def q_dash_minute(spark, sf):
    return D.dash_minute(Pipeline(spark, sf).audience, MINUTE_DAY, MINUTE_STATIONS)


# ---- 2.9 data quality (violating rows; empty = pass) ----------------------------

def _against_stations(p: Pipeline, common: DataFrame, mart: str, kind: str) -> DataFrame:
    """Separately stored station marts against a common mart made in one pass."""
    out = _stored_stations(p, mart)
    return Q.common_totals_match({s: B.station_mart(p.spark, out, mart, s) for s in NETWORKS}, common, kind)


#: Check -> its rows, from stages (raw, clean, ...), and the stages that its
#: ``_faulty`` twin replaces by ones with seeded faults (sources/faults.py).
CHECKS = {
    "dq_not_null": (lambda p: Q.not_null(p.clean, CLEAN_COLUMNS), ("clean",)),
    "dq_unique_grain": (lambda p: Q.unique_grain(p.daily, DAILY_KEYS), ("daily",)),
    "dq_unique": (lambda p: Q.unique(p.clean, "EVENT_ID"), ("clean",)),
    "dq_accepted_values": (lambda p: Q.accepted_values(p.clean, "GENRE", GENRES), ("clean",)),
    "dq_accepted_station": (lambda p: Q.accepted_values(p.clean, "NETWORK_ID", NETWORKS), ("clean",)),
    "dq_device_id": (lambda p: Q.invalid_device_ids(p.clean), ("clean",)),
    "dq_device_id_range": (lambda p: Q.device_id_out_of_range(p.predictions), ("predictions",)),
    "dq_valid_intervals": (lambda p: Q.invalid_intervals(p.clean), ("clean",)),
    "dq_station_volume": (lambda p: Q.station_volume(p.raw, p.clean, p.daily), ("clean", "daily")),
    "dq_minute_expansion": (lambda p: Q.minute_expansion(p.clean, p.minutes), ("minutes",)),
    "dq_minute_audience": (lambda p: Q.minute_audience_matches(p.minutes, p.audience), ("audience",)),
    "dq_common_daily": (lambda p: _against_stations(p, p.daily, "mart_device_daily", "daily"), ("daily",)),
    "dq_common_minute": (lambda p: _against_stations(p, p.audience, "mart_minute_audience", "minute"), ("audience",)),
    "feature_checks": (lambda p: MF.feature_checks(p.features, p.labels), ("features", "labels")),
}


def _check(name: str, faulty: bool) -> Query:
    rows, replaced = CHECKS[name]

    def run(spark, sf):
        p = Pipeline(spark, sf)
        if faulty:  # every stage is planned before one is replaced: faults don't spread
            p.__dict__.update({stage: getattr(faults, stage)(getattr(p, stage)) for stage in reversed(replaced)})
        return rows(p)
    return run


for _name in CHECKS:
    QUERIES[_name], QUERIES[_name + "_faulty"] = _check(_name, False), _check(_name, True)


@query("dq_report")
def q_dq_report(spark, sf):
    return B.full_report(Pipeline(spark, sf).raw, materialize=True)


@query("gate_report")
def q_gate_report(spark, sf):
    """Build, check and publish; the rows the gate judged. A build
    with violations is not published, and its rows say what they are."""
    out = _new_folder(spark, "build")
    try:
        B.publish_common(Pipeline(spark, sf).raw, out)
    except B.ViolationsError:
        pass
    return B.gate_report(spark, out)


@query("label_coverage")
def q_label_coverage(spark, sf):
    p = Pipeline(spark, sf)
    return Q.label_coverage(p.labels, p.daily)


# ---- 2.3 interval folding --------------------------------------------------------

@query("fold_intervals")
def q_fold_intervals(spark, sf):
    return I.fold_intervals(Pipeline(spark, sf).clean)


@query("fold_totals")
def q_fold_totals(spark, sf):
    return I.fold_totals(I.fold_intervals(Pipeline(spark, sf).clean))


@query("fold_rows")
def q_fold_rows(spark, sf):
    """The totals on every folded row."""
    return I.fold_with_totals(I.fold_intervals(Pipeline(spark, sf).clean), _new_folder(spark, "fold"))


# ---- 2.10 prediction snapshot ------------------------------------------------------

def _known_devices(p: Pipeline) -> DataFrame:
    """How many devices must have a prediction: those of the label table."""
    return p.labels.agg(F.count_distinct("DEVICE_ID"))


@query("prediction_health")
def q_prediction_health(spark, sf):
    return P.prediction_health(Pipeline(spark, sf).predictions)


@query("selected_health")
def q_selected_health(spark, sf):
    return P.selected_health(P.selected_devices(Pipeline(spark, sf).daily))


@query("unique_predictions")
def q_unique_predictions(spark, sf):
    return P.unique_predictions(Pipeline(spark, sf).predictions)


@query("pred_join_strict")
def q_pred_join_strict(spark, sf):
    p = Pipeline(spark, sf)
    return P.selected_devices(p.daily).join(P.unique_predictions(p.predictions), "DEVICE_ID", "left")


@query("pred_join_compact")
def q_pred_join_compact(spark, sf):
    p = Pipeline(spark, sf)
    return P.selected_devices(p.daily).join(p.predictions, "DEVICE_ID")


@query("prediction_distribution")
def q_prediction_distribution(spark, sf):
    p = Pipeline(spark, sf)
    return P.prediction_distribution(P.selected_devices(p.daily), p.predictions)


@query("prediction_snapshot")
def q_prediction_snapshot(spark, sf):
    p = Pipeline(spark, sf)
    return P.prediction_snapshot(p.daily, p.predictions)


@query("prediction_snapshot_compact")
def q_prediction_snapshot_compact(spark, sf):
    p = Pipeline(spark, sf)
    return P.prediction_snapshot_compact(p.daily, p.predictions)


@query("probability_histogram")
def q_probability_histogram(spark, sf):
    p = Pipeline(spark, sf)
    return P.probability_histogram(P.prediction_snapshot(p.daily, p.predictions))


@query("prediction_class_counts")
def q_prediction_class_counts(spark, sf):
    return P.prediction_class_counts(Pipeline(spark, sf).predictions)


@query("validated_snapshot")
def q_validated_snapshot(spark, sf):
    p = Pipeline(spark, sf)
    return P.shown(P.validated_snapshot(P.prediction_snapshot(p.daily, p.predictions), _known_devices(p)))


@query("dash_predictions")
def q_dash_predictions(spark, sf):
    p = Pipeline(spark, sf)
    taken = P.take_snapshot(FOCUS.apply(p.daily), p.predictions, _new_folder(spark, "snapshots"))
    return P.shown(P.prediction_views(P.validated_snapshot(P.snapshot_of(taken), _known_devices(p))))


# ---- 2.12 semantic metric view ---------------------------------------------------------

@query("metric_view_total")
def q_metric_view_total(spark, sf):
    return S.viewing_metric_view(Pipeline(spark, sf).daily).query()


@query("metric_view_by")
def q_metric_view_by(spark, sf):
    view = S.viewing_metric_view(Pipeline(spark, sf).daily)
    return view.ask(["リーチ", "total_minutes", "セッション数"], ["局", "genre"])


@query("metric_view_reconcile")
def q_metric_view_reconcile(spark, sf):
    p = Pipeline(spark, sf)
    return S.reconcile(S.viewing_metric_view(p.daily), p.clean)


# ---- 2.11 machine learning (data side) ------------------------------------------------

@query("device_features")
def q_device_features(spark, sf):
    return Pipeline(spark, sf).features


@query("features_labeled")
def q_features_labeled(spark, sf):
    return Pipeline(spark, sf).labeled


@query("stratified_split")
def q_stratified_split(spark, sf):
    return Pipeline(spark, sf).split


@query("eda_label_counts")
def q_eda_label_counts(spark, sf):
    return MF.eda_label_counts(Pipeline(spark, sf).train)


@query("eda_box_stats")
def q_eda_box_stats(spark, sf):
    return MF.eda_box_stats(Pipeline(spark, sf).train)


@query("eda_group_means")
def q_eda_group_means(spark, sf):
    return MF.eda_group_means(Pipeline(spark, sf).train)


@query("eda_genre_means")
def q_eda_genre_means(spark, sf):
    return MF.eda_genre_means(Pipeline(spark, sf).train)


def _fixture_scored(p: Pipeline) -> DataFrame:
    """Test devices scored by the deterministic prediction snapshot (oracle-able)."""
    return p.test.select("DEVICE_ID", "TARGET_F1").join(p.predictions.select("DEVICE_ID", "PROB_F1"), "DEVICE_ID")


@query("eval_auc")
def q_eval_auc(spark, sf):
    return ME.eval_auc(_fixture_scored(Pipeline(spark, sf)))


@query("eval_threshold_metrics")
def q_eval_threshold_metrics(spark, sf):
    return ME.eval_threshold_metrics(_fixture_scored(Pipeline(spark, sf)))


@query("eval_confusion")
def q_eval_confusion(spark, sf):
    return ME.eval_confusion(_fixture_scored(Pipeline(spark, sf)))


# ---- 2.11 machine learning (model side) ---------------------------------------------------

@query("train_model")
def q_train_model(spark, sf):
    return MJ.test_scores(spark, sf)


@query("register_model")
def q_register_model(spark, sf):
    path = MJ.register(spark, sf)
    return spark.read.text(f"{path}/metadata").select(
        F.get_json_object("value", "$.MODEL_NAME").alias("MODEL_NAME"),
        F.get_json_object("value", "$.MODEL_VERSION").alias("MODEL_VERSION"),
        F.get_json_object("value", "$.DATASET_VERSION").alias("DATASET_VERSION"),
        F.get_json_object("value", "$.METRICS.ROC_AUC").cast("double").alias("ROC_AUC"))


@query("explain_model")
def q_explain_model(spark, sf):
    return MJ.explanations(spark, sf)


@query("explain_ranking")
def q_explain_ranking(spark, sf):
    return MX.mean_abs_ranking(MJ.explanations(spark, sf))


@query("explain_background")
def q_explain_background(spark, sf):
    return MJ.background_explanations(spark, sf)


@query("explain_device")
def q_explain_device(spark, sf):
    """M13 for one device: what moved the highest score, and which way."""
    return MX.device_direction(MJ.background_explanations(spark, sf))


@query("model_report")
def q_model_report(spark, sf):
    return MJ.model_report(spark, sf)


@query("score_devices")
def q_score_devices(spark, sf):
    return MJ.all_scores(spark, sf)


@query("publish_predictions")
def q_publish_predictions(spark, sf):
    return MJ.publish(spark, sf)


@query("top5_per_class")
def q_top5_per_class(spark, sf):
    top = MJ.top_per_class(Pipeline(spark, sf).predictions)
    MJ.require_both_classes(top.collect())  # at most ten rows
    return top


# ---- 2.1 ingestion and sinks -------------------------------------------------------------

#: Table -> schema and partition columns of its deployed and its loaded form.
LOADED = {"VIEWING_LOG": (VIEWING_LOG, ("NETWORK_ID",)), "DEVICE_LABELS": (DEVICE_LABELS, ()),
          "PROGRAM_MASTER": (PROGRAM_MASTER, ()), "PROGRAM_SCHEDULE": (PROGRAM_SCHEDULE, ())}


def _new_folder(spark, name: str) -> str:
    """A folder of this call's own, so that no result depends on earlier runs."""
    return f"{output_dir(spark)}/{name}/run={uuid.uuid4().hex}"


def _deployed(spark, sf) -> str:
    return testdata.deploy(spark, sf, _new_folder(spark, "deployed"))


def _loaded(spark, source: str, *tables: str) -> LoadHistory:
    history = LoadHistory(spark, _new_folder(spark, "loaded"))
    for table in tables:
        schema, by = LOADED[table]
        for _ in range(2):  # the second run must find nothing to load
            history.load(source, table, DATASET_VERSION, schema, by)
    return history


@query("ingest_load_once")
def q_ingest_load_once(spark, sf):
    return _loaded(spark, _deployed(spark, sf), "VIEWING_LOG").table("VIEWING_LOG", VIEWING_LOG, DATASET_VERSION)


@query("ingest_stream")
def q_ingest_stream(spark, sf):
    """S8 as a stream: the file source's checkpoint is the load history."""
    events, base = testdata.table(spark, sf, "events"), _new_folder(spark, "ingest")
    loaded = None
    for _ in range(2):  # the second run must append nothing
        loaded = load_once(spark, f"{sf.rstrip('/')}/events*.parquet", events.schema, f"{base}/raw_viewing_log", f"{base}/checkpoint",
                           transform=testdata.viewing_log_from_events, out_schema=VIEWING_LOG, partition_by=["NETWORK_ID"])
    return loaded


@query("ingest_row_counts")
def q_ingest_row_counts(spark, sf):
    """Loaded rows against the rows in the deployed files' footers."""
    source = _deployed(spark, sf)
    history = _loaded(spark, source, *LOADED)
    tables, expected = {}, {}
    for table, (schema, _) in LOADED.items():
        rows, files = history.table(table, schema, DATASET_VERSION), readers.versioned(source, DATASET_VERSION, table)
        if table == "VIEWING_LOG":
            for s in NETWORKS:
                tables[f"{table}_{s}"] = rows.filter(F.col("NETWORK_ID") == s)
                expected[f"{table}_{s}"] = readers.stored_rows(spark, f"{files}/NETWORK_ID={s}").first()[0]
        else:
            tables[table], expected[table] = rows, readers.stored_rows(spark, files).first()[0]
    return readers.row_counts(tables, expected)


@query("sink_predictions")
def q_sink_predictions(spark, sf):
    snap = Pipeline(spark, sf).predictions
    path = f"{MJ.registry_root(spark, sf)}/sink_predictions"
    return MM.publish_predictions(snap, path, expected_rows=snap.count(),
                               predicted_at=dt.datetime(2024, 2, 1))


# ---- 2.13 search --------------------------------------------------------------------------

@query("search_vector_topk")
def q_search_vector_topk(spark, sf):
    vectors = testdata.table(spark, sf, "embeddings")
    return SR.vector_topk(vectors, SR.label_centroids(vectors), k=3)


@query("search_vector_all")
def q_search_vector_all(spark, sf):
    """F1 without a filter, with a returned column."""
    vectors = testdata.table(spark, sf, "embeddings")
    return SR.vector_topk(vectors, SR.label_centroids(vectors), k=3, filter_col=None, returned=("label",))


@query("search_text_topk")
def q_search_text_topk(spark, sf):
    docs = testdata.table(spark, sf, "documents")
    bench = testdata.table(spark, sf, "benchmark").select(F.col("item_id").alias("QUERY_ID"),
                                                          F.col("text").alias("QUERY_TEXT"))
    return SR.text_topk(docs, bench, k=3)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


__all__ = ["queries", "QUERIES"]
