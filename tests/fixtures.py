"""Worked examples of the reference, as fixed test data."""

from pyspark.sql import functions as F


def genre_guide(spark):
    """The five-entry genre guide of the text-search example."""
    # The guide texts and the sample question, as the reference states them.
    rows = [
        ("NEWS", "NEWS ニュース。社会の出来事、地域の話題、政治や経済の動きを伝えるジャンル。教材用の架空説明です。"),
        ("DRAMA", "DRAMA ドラマ。登場人物の関係や成長を物語として描くジャンル。教材用の架空説明です。"),
        ("VARIETY", "VARIETY バラエティ。トーク、クイズ、企画などを楽しむジャンル。教材用の架空説明です。"),
        ("ANIME", "ANIME アニメ。アニメーションで物語やキャラクターを表現するジャンル。教材用の架空説明です。"),
        ("SPORTS", "SPORTS スポーツ。試合の結果、選手の活躍、競技の解説や中継を扱うジャンル。教材用の架空説明です。"),
    ]
    return spark.createDataFrame(rows, "GENRE string, GUIDE_TEXT string")


GUIDE_SAMPLE_QUERY = "試合の結果や選手の活躍を知りたい"


def fold_example(spark):
    """T5: the seven-interval worked example (3 folded intervals of 4, 2, 1 rows)."""
    # The example's intervals, in its order.
    times = [("2026-07-01 08:00:00", "2026-07-01 08:30:00"), ("2026-07-01 08:05:00", "2026-07-01 08:10:00"),
             ("2026-07-01 08:25:00", "2026-07-01 08:40:00"), ("2026-07-01 08:40:00", "2026-07-01 08:50:00"),
             ("2026-07-01 09:00:00", "2026-07-01 09:10:00"), ("2026-07-01 09:10:00", "2026-07-01 09:20:00"),
             ("2026-07-01 10:00:00", "2026-07-01 10:05:00")]
    rows = [(n, "C000001", "NW01", "NEWS", *t) for n, t in enumerate(times, 1)]
    df = spark.createDataFrame(rows, "EVENT_ID int, DEVICE_ID string, NETWORK_ID string, GENRE string, START string, END string")
    return df.select("EVENT_ID", "DEVICE_ID", "NETWORK_ID", "GENRE", F.col("START").cast("timestamp_ntz").alias("VIEW_FROM"),
                     F.col("END").cast("timestamp_ntz").alias("VIEW_TO"))
