"""The reference's jobs as DataFrame plans (batch input; see
``eventide.streaming.jobs`` for the stream runners).

Parameters default to the reference's values: hop 60 s / 1 s and top 5 or
top 10 for the click rankings, tumbling 10 s, sliding 10 min / 60 s and a
5 min session gap for the metric windows, factor 12 for the hash function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions import hash_code
from eventide.operators import (avg_, count_, explode_json, hop_agg, live_clicks, max_, min_, running_topn,
                                session_agg, token_count, topn_json, tumble_agg, window_topn, word_count)

# Window sizes and ranks of the reference jobs.
CLICK_WINDOW, CLICK_SLIDE = "60 seconds", "1 second"
CLICK_TOP_SQL, CLICK_TOP_UDF = 5, 10
TUMBLE_SIZE = "10 seconds"
SLIDE_SIZE, SLIDE_STEP = "10 minutes", "60 seconds"
SESSION_GAP = "5 minutes"
HASH_FACTOR = 12


def wordcount(words: DataFrame) -> DataFrame:
    """SELECT word, count(1) AS cnt FROM words GROUP BY word."""
    return word_count(words)


def wordcount_tokens(docs: DataFrame, spread_to: int | None = None) -> DataFrame:
    return token_count(docs, "text", " ", spread_to=spread_to)


def sex_count(actions: DataFrame, size: str = CLICK_WINDOW, slide: str = CLICK_SLIDE, strategy: str = "direct",
              spread_to: int | None = None) -> DataFrame:
    """Live clicks per sex and hop window -> sex, cnt, start_time, end_time."""
    out = hop_agg(live_clicks(actions), "ts", size, slide, ["sex"], [count_("cnt")], strategy, spread_to)
    return out.select("sex", "cnt", "start_time", "end_time")


def sex_topn(actions: DataFrame, n: int = CLICK_TOP_SQL, size: str = CLICK_WINDOW,
             slide: str = CLICK_SLIDE, strategy: str = "direct", spread_to: int | None = None) -> DataFrame:
    """Top-n names per (hop window, sex) -> start_time, end_time, sex, name, cnt."""
    out = window_topn(live_clicks(actions), "ts", size, slide, ["sex"], "name", n, strategy, spread_to)
    return out.select("start_time", "end_time", "sex", "name", "cnt")


def sex_top_json(actions: DataFrame, n: int = CLICK_TOP_UDF, size: str = CLICK_WINDOW,
                 slide: str = CLICK_SLIDE, strategy: str = "direct", spread_to: int | None = None) -> DataFrame:
    """TopN(name, n) aggregate as JSON text -> sex, top10, start_time, end_time."""
    return topn_json(live_clicks(actions), "ts", size, slide, "sex", "name", n, "top10", strategy, spread_to)


def running_top(actions: DataFrame, n: int = CLICK_TOP_UDF) -> DataFrame:
    """Unwindowed top-n names per sex over all actions (no filter) -> sex, name, cnt."""
    return running_topn(actions, "sex", "name", n).select("sex", "name", "cnt")


def cpu_tumbling(cpu: DataFrame, size: str = TUMBLE_SIZE) -> DataFrame:
    return tumble_agg(cpu, "ts", size, ["cluster_name"],
                      [max_("cpu_usage", "max_cpu_usage"), min_("cpu_usage", "min_cpu_usage"),
                       avg_("cpu_usage", "avg_cpu_usage")])


def cpu_sliding(cpu: DataFrame, size: str = SLIDE_SIZE, slide: str = SLIDE_STEP,
                strategy: str = "auto", spread_to: int | None = None) -> DataFrame:
    return hop_agg(cpu, "ts", size, slide, ["cluster_name"], [count_("cnt")], strategy, spread_to)


def cpu_session(cpu: DataFrame, gap: str = SESSION_GAP, strategy: str = "buckets") -> DataFrame:
    return session_agg(cpu, "ts", gap, ["cluster_name"], [count_("cnt")], strategy=strategy)


def with_hash(words: DataFrame, factor: int = HASH_FACTOR) -> DataFrame:
    """select(id, word, hash_code(id)) -> id, word, hash_id."""
    return words.select("id", "word", hash_code("id", factor).alias("hash_id"))


def split_lateral(input_table: DataFrame, outer: bool = False) -> DataFrame:
    return explode_json(input_table, "bs_info", ["id"], outer=outer)
