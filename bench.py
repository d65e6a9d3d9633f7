"""Time the headline queries and print one JSON line.

Every question runs once to warm up and three times for its median, over the folder in ``BENCH_SF_DIR``.  Over
that folder and over the hundredth-scale one beside it: the mix of questions 1, 4, 6 and 12, one after the
other and from sixteen threads of one session.  Over the smaller one also what the baseline lists: one load step,
the initial load, and the checks of primary and foreign keys.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradewind.operators import warehouse  # noqa: E402
from tradewind.registry import TITLES, all_queries  # noqa: E402
from tradewind.session import build, scratch  # noqa: E402
from tradewind.sources.generate import Generator  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "*")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
MIX = ("q01", "q04", "q06", "q12")
CLIENTS = 16


def seconds(action) -> float:
    began = time.perf_counter()
    action()
    return round(time.perf_counter() - began, 4)


def mix_rates(run, names: dict[str, str], folder: str, streams: int = 5) -> dict[str, float]:
    """Queries per minute of the mix from one client and from sixteen."""
    one = lambda _: [run(names[q], folder) for q in MIX]
    one(0)
    alone = seconds(lambda: [one(i) for i in range(streams)])
    with ThreadPoolExecutor(CLIENTS) as pool:
        together = seconds(lambda: list(pool.map(one, range(CLIENTS * 2))))
    return {"one_client": round(streams * len(MIX) / alone * 60, 1),
            "sixteen_clients": round(CLIENTS * 2 * len(MIX) / together * 60, 1)}


def main() -> None:
    shuffle = CPUS if CPUS.isdigit() else str(os.cpu_count())
    spark = build(f"local[{CPUS}]", "bench", **{
        "spark.sql.shuffle.partitions": shuffle, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    names = {short: f"{short}_{title}" for short, title in TITLES.items()}
    run = lambda name, folder: registered[name](spark, folder).collect()
    timings = {}
    for short, name in names.items():
        run(name, FOLDER)
        timings[short] = statistics.median(seconds(lambda: run(name, FOLDER)) for _ in range(RUNS))
    small = os.path.join(os.path.dirname(FOLDER.rstrip("/")), "sf0.01")
    rates = {os.path.basename(f.rstrip("/")): mix_rates(run, names, f)
             for f in dict.fromkeys((FOLDER, small)) if os.path.isdir(f)}
    baseline = {"load_step_scale_1_step_1_of_100": seconds(
        lambda: warehouse.load_step(Generator(spark, 1, children=100, step=1), scratch(spark, "bench-step")))}
    if os.path.isdir(small):
        for key, name in (("initdb", "initial_load"), ("primary_keys", "check_primary_keys"),
                          ("foreign_keys", "check_foreign_keys"), ("drop_tables", "drop_tables")):
            baseline[f"{key}_sf0.01"] = seconds(lambda: run(name, small))
    print(json.dumps({
        "metric": "sum of median seconds of the 22 questions", "value": round(sum(timings.values()), 4),
        "unit": "sec", "queries": timings, "sf": os.path.basename(FOLDER.rstrip("/")),
        "mix_queries_per_minute": rates, "baseline_seconds": baseline,
        "cores": CPUS if CPUS.isdigit() else os.cpu_count(), "driver_memory": "16g",
    }))


if __name__ == "__main__":
    main()
