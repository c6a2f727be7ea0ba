"""Time the headline queries: one JSON line on standard output.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query runs to its last row, into a sink
that keeps nothing. A first pass over two queries warms up the session and is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.registry import QUERIES  # noqa: E402
from lexmill.runtime import local_session  # noqa: E402

HEADLINE = """p7_pair_views p8_batches_shuffled t4_clean_articles a1_class_word_freq a3_vocab_index a4_bag_of_words c5_accuracy
c7_best_epochs e0_corpus_vocab e5_train_features e4_decode g0_bigram_table g4_synthesis g5_synthesis_titles g6_greedy_titles
g8_beam_titles_no_repeat o1_rouge_2 o1l_rouge_l o4_token_nll o5_batch_rewards""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("lexmill-bench", cores, **{"spark.sql.shuffle.partitions": cores, "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in ("c4_argmax_label", "g6_greedy_titles"):
        run(name)
    times = {name: run(name) for name in (sys.argv[1:] or HEADLINE)}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
