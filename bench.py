"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textspark.registry import QUERIES  # noqa: E402
from textspark.session import local_session  # noqa: E402

HEADLINE = [
    "token_freq",
    "tokenize_raw",
    "word_ngrams",
    "char_wb_ngrams",
    "bow",
    "tfidf",
    "vocab_build",
    "encode_docs",
    "features_fit_transform",
    "features_by_split",
    "softmax_grad",
    "minibatch",
    "graph_edges",
    "graph_nodes",
    "edge_attention",
    "diffusion_k",
    "gat_layer",
    "gat_stack",
    "softmax_fit",
    "compare_features",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores)
    # Session start and the first compilation are not query time.
    QUERIES["token_freq"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        # Every column of every row is computed, none is sent to the driver.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
