"""Load-once ingestion and top-k search."""

import uuid

from pyspark.sql import functions as F

from tvpulse.operators import search as SR
from tvpulse.sources import testdata
from tvpulse.streaming.ingest import load_once

from conftest import SF001
from fixtures import GUIDE_SAMPLE_QUERY, genre_guide


def test_load_once_appends_only_new_files(spark, scratch):
    base = f"{scratch}/ingest-{uuid.uuid4().hex}"
    src, target, ckpt = f"{base}/src", f"{base}/target", f"{base}/ckpt"
    events = testdata.table(spark, SF001, "events")
    events.filter("event_id < 500").write.parquet(f"{src}/part=1")
    schema = events.schema
    first = load_once(spark, f"{src}/*", schema, target, ckpt).count()
    again = load_once(spark, f"{src}/*", schema, target, ckpt).count()
    assert first == again == 500
    events.filter("event_id >= 500").write.parquet(f"{src}/part=2")
    assert load_once(spark, f"{src}/*", schema, target, ckpt).count() == events.count()


def test_text_search_finds_sports_for_the_sample_query(spark):
    guide = genre_guide(spark)
    q = spark.createDataFrame([(1, GUIDE_SAMPLE_QUERY)], "QUERY_ID int, QUERY_TEXT string")
    top = SR.text_topk(guide, q, k=3, id_col="GENRE", text_col="GUIDE_TEXT").orderBy("RANK").collect()
    assert 1 <= len(top) <= 3 and top[0].GENRE == "SPORTS"


def test_text_search_ranks_a_document_first_for_its_own_text(spark):
    docs = testdata.table(spark, SF001, "documents")
    q = docs.orderBy("doc_id").limit(3).select(F.col("doc_id").alias("QUERY_ID"), F.col("text").alias("QUERY_TEXT"))
    top = SR.text_topk(docs, q, k=1).join(docs.select("doc_id", "text"), "doc_id").join(q, "QUERY_ID").collect()
    assert len(top) == 3
    assert all(r.SCORE == 1.0 and r.text == r.QUERY_TEXT for r in top)


def test_text_search_attribute_filter(spark):
    docs = testdata.table(spark, SF001, "documents")
    q = spark.createDataFrame([(1, "the quick brown fox")], "QUERY_ID int, QUERY_TEXT string")
    hits = SR.text_topk(docs, q, k=3, filter_col="lang", filter_value="fr").join(docs, "doc_id")
    assert {r.lang for r in hits.collect()} == {"fr"}


def test_vector_search_returns_members_of_the_label(spark):
    vecs = testdata.table(spark, SF001, "embeddings")
    res = SR.vector_topk(vecs, SR.label_centroids(vecs), k=3).join(vecs, "vec_id")
    rows = res.collect()
    assert rows and all(r.label == r.QUERY_ID for r in rows)
    assert max(r.RANK for r in rows) == 3


def test_vector_search_equals_brute_force_in_any_blocks(spark, monkeypatch):
    """Unfiltered and filtered; null, zero, odd and non-finite vectors, ties, repeats."""
    import math
    import random

    rng = random.Random(2)
    vectors = {i: [rng.gauss(0, 1) for _ in range(4)] for i in range(60)}
    vectors |= {60: None, 61: [0.0] * 4, 62: [1.0, 2.0], 63: [math.nan, 1.0, 1.0, 1.0], 64: [math.inf, 1.0, 1.0, 1.0],
                65: [1.0, None, 1.0, 1.0], 66: vectors[3], 67: [2 * x for x in vectors[3]], 68: [1e-200] * 4}
    corpus = spark.createDataFrame([(i, v, i % 3, f"name {i}") for i, v in vectors.items()],
                                   "vec_id long, embedding array<double>, label int, name string").repartition(4)
    asked = {1: vectors[3], 2: [1.0, 0.0, 0.0, 0.0], 3: [1.0, 2.0], 4: [0.0] * 4, 5: None}
    queries = spark.createDataFrame([(q, v, q % 3) for q, v in asked.items()], "QUERY_ID int, QUERY_VECTOR array<double>, FILTER_VALUE int")

    def usable(v):
        return v is not None and None not in v and all(map(math.isfinite, v)) and sum(x * x for x in v) > 0

    def want(filtered):
        out = []
        for q, a in asked.items():
            if not usable(a):
                continue
            found = []
            for i, v in vectors.items():
                if usable(v) and len(v) == len(a) and (not filtered or i % 3 == q % 3):
                    cosine = sum(x * y for x, y in zip(a, v)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in v))
                    found.append((-round(cosine, 9), i))
            out += [(q, i, -s, n) for n, (s, i) in enumerate(sorted(found)[:3], 1)]
        return sorted(out)

    for cells in (SR.BLOCK_CELLS, 1):
        monkeypatch.setattr(SR, "BLOCK_CELLS", cells)
        for filtered in (False, True):
            got = SR.vector_topk(corpus, queries, 3, filter_col="label" if filtered else None, returned=("label", "name"))
            rows = got.collect()
            assert sorted((r.QUERY_ID, r.vec_id, r.SCORE, r.RANK) for r in rows) == want(filtered)
            assert all(r.label == r.vec_id % 3 and r.name == f"name {r.vec_id}" for r in rows)
    assert SR.vector_topk(corpus.limit(0), queries, 3, filter_col=None).count() == 0
    assert SR.vector_topk(corpus, queries.limit(0), 3, filter_col=None).count() == 0


def test_text_search_equals_brute_force_in_any_blocks(spark, monkeypatch):
    """Emoji, line separators, ties and empty texts; one block and many."""
    import math
    import re
    from collections import Counter

    texts = {1: "one \U0001F600 two", 2: "one \u2028 two\u0085", 3: None, 4: "", 5: "x", 6: "One  two",
             7: "one two", 8: "\U0001F600\U0001F600\U0001F600", 9: "nothing like it: 7531"}
    asked = {1: "one two", 2: "a \u2028 b", 3: "\U0001F600\U0001F600", 4: "", 5: "zq#~"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id int, text string").repartition(3)
    queries = spark.createDataFrame(list(asked.items()), "QUERY_ID int, QUERY_TEXT string")

    def grams(t):
        t = re.sub(r"[ \t\n\x0b\f\r]+", " ", (t or "").lower())
        return Counter(zip(t, t[1:]))

    tf = {i: grams(t) for i, t in texts.items()}
    df = Counter(g for c in tf.values() for g in c)
    weigh = lambda c: {g: n * (math.log((1 + len(texts)) / (1 + df[g])) + 1) for g, n in c.items()}
    norm = lambda w: math.sqrt(sum(v * v for v in w.values()))
    want = []
    for q, t in asked.items():
        w = weigh(grams(t))
        found = []
        for i, c in tf.items():
            d = weigh(c)
            if set(w) & set(d):
                found.append((-round(sum(w[g] * d[g] for g in set(w) & set(d)) / norm(w) / norm(d), 9), i))
        want += [(q, i, -s, r) for r, (s, i) in enumerate(sorted(found)[:3], 1)]
    for cells in (SR.BLOCK_CELLS, 1):
        monkeypatch.setattr(SR, "BLOCK_CELLS", cells)
        got = SR.text_topk(docs, queries, k=3).select("QUERY_ID", "doc_id", "SCORE", "RANK").collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_text_search_tasks_keep_at_most_k_rows_per_query(spark):
    import pandas as pd

    weights = pd.DataFrame({"QUERY_ID": [1, 2], "GRAM": [(97 << 21) | 98, (98 << 21) | 97], "W": [1.0, 1.0]})
    batches = [pd.DataFrame({"doc_id": range(n, n + 3000), "_t": ["aba"] * 3000, "_norm": [1.0] * 3000})
               for n in (0, 3000)]
    kept = pd.concat(SR._block_best(spark, "doc_id", weights, 3)(iter(batches)))
    assert sorted(zip(kept.QUERY_ID, kept.doc_id)) == [(q, d) for q in (1, 2) for d in (0, 1, 2)]


def test_typed_reader_matches_names_ignoring_case_and_aborts_on_bad_values(spark, scratch):
    import datetime as dt

    import pytest
    from tvpulse.plans.pipeline import Pipeline
    from tvpulse.sources import readers

    path = f"{scratch}/logs-{uuid.uuid4().hex}"
    rows = [("E1", "NW01", "C000001", dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 9), "NEWS"),
            ("E2", "NW02", "C000002", dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 8, 30), "news")]
    spark.createDataFrame(rows, "event_id string, network_id string, device_id string, view_from timestamp_ntz, "
                                "view_to timestamp_ntz, genre string").write.partitionBy("network_id").parquet(path)
    logs = readers.viewing_log(spark, path, "NW02")
    assert logs.columns == ["EVENT_ID", "NETWORK_ID", "DEVICE_ID", "VIEW_FROM", "VIEW_TO", "GENRE"]
    assert [r.EVENT_ID for r in logs.collect()] == ["E2"]
    assert Pipeline.from_files(spark, path).daily.count() == 2
    bad = f"{scratch}/bad-{uuid.uuid4().hex}"
    spark.createDataFrame([("E1", "NW01", "C1", "not a time", "2024-01-01 09:00:00", "NEWS")],
                          "EVENT_ID string, NETWORK_ID string, DEVICE_ID string, VIEW_FROM string, VIEW_TO string, "
                          "GENRE string").write.parquet(bad)
    with pytest.raises(Exception):
        readers.viewing_log(spark, bad).collect()


def test_command_line_writes_station_partitioned_logs(spark, scratch, capsys):
    from tvpulse.__main__ import main
    out = f"{scratch}/cli-{uuid.uuid4().hex}"
    assert main(["testdata", "--sf", SF001, "--out", out]) == 0
    logs = spark.read.parquet(out)
    assert logs.count() == testdata.viewing_log(spark, SF001).count()
    import os
    assert sorted(d for d in os.listdir(out) if d.startswith("NETWORK_ID=")) == [
        f"NETWORK_ID=NW0{i}" for i in range(1, 6)]


def test_schedule_is_dealt_out_by_its_rows(spark, monkeypatch):
    """The few bytes of ``part`` don't leave the whole schedule to one task."""
    from tvpulse.sources import testdata
    whole = sorted(map(tuple, testdata.program_schedule(spark, SF001).collect()))
    monkeypatch.setattr(testdata, "SCHEDULE_ROWS_PER_TASK", len(whole) // 5)
    dealt = testdata.program_schedule(spark, SF001)
    per_task = [n for n in dealt.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert len(per_task) >= 3 and max(per_task) < len(whole) // 2
    assert sorted(map(tuple, dealt.collect())) == whole
