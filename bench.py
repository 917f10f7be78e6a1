"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every stage runs, nothing
is collected to the driver).  One warm-up pass, then the median of
$BENCH_REPEAT timed runs per query.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from loanlife.functions.exprs import waterfall  # noqa: E402
from loanlife.operators.detail import servicing_detail  # noqa: E402
from loanlife.operators.events import BUCKETS, bucket_condition, d180_condition, mod_condition  # noqa: E402
from loanlife.operators.master import loan_master  # noqa: E402
from loanlife.operators.outcomes import T  # noqa: E402
from loanlife.plans.job import read_feeds  # noqa: E402
from loanlife.plans.master_store import MasterStore  # noqa: E402
from loanlife.plans.queries import QUERIES  # noqa: E402
from loanlife.schema import ORIG_SPEC, SVCG_SPEC  # noqa: E402
from loanlife.session import local_session, scratch_path  # noqa: E402
from loanlife.sources.panel import panel  # noqa: E402
from loanlife.sources.panel_table import PanelTable  # noqa: E402

HEADLINE = [
    "loan_master", "servicing_detail", "dlq_90", "pd_d180", "first_mod", "terminal_record",
    "default_loss", "default_disposition", "union_distinct", "first_by_bucket", "left_chain",
    "dedupe_rows", "join_three", "page_links",
    "loan_master_parquet", "loan_master_parquet_bounded", "loan_master_text", "loan_master_buckets", "loan_master_state",
]


def join_chain_master(spark, sf_dir: str):
    """The original program's plan shape, for comparison only: per event a filter, a
    per-loan minimum and a join back (a self-join), the terminal row the same way with
    the maximum, then a chain of left joins.  Same detail and rules as ``loan_master``,
    so only the plan shape differs."""
    orig, svcg = panel(spark, sf_dir, cluster=True)
    d = servicing_detail(svcg, orig, bounded_loans=True)

    def first(cond, ind, upb):
        x = d.where(cond)
        m = x.groupBy("id_loan").agg(F.min("rn").alias("rn"))
        return x.join(m, ["id_loan", "rn"]).select(
            "id_loan", F.lit(1).alias(ind), waterfall("act_endg_upb", "prior_upb", "orig_upb").alias(upb))

    last = d.join(d.groupBy("id_loan").agg(F.max("rn").alias("rn")), ["id_loan", "rn"])
    t = T("")
    trm = last.select("id_loan", t.collateral_deficiency().alias("collateral_deficiency"),
                      t.current_int_rt().alias("current_int_rt"), t.default_upb().alias("default_upb"),
                      t.dlq_accrued_interest().alias("dlq_accrued_interest"),
                      t.prepay_count().alias("prepay_count"), t.default_count().alias("default_count"),
                      t.prepay_upb().alias("prepay_upb"), t.rmng_upb().alias("rmng_upb"))
    out = orig.join(trm, "id_loan", "left")
    for b, name in BUCKETS:
        out = out.join(first(bucket_condition(b), f"{name}_ind", f"{name}_upb"), "id_loan", "left")
    out = out.join(first(mod_condition(), "mod_ind", "mod_upb"), "id_loan", "left")
    return out.join(first(d180_condition(), "pd_d180_ind", "pd_d180_upb"), "id_loan", "left")


def one_pass_master(spark, sf_dir: str):
    """``loan_master`` restricted to the columns the join-chain shape produces."""
    chain_cols = join_chain_master(spark, sf_dir).columns
    orig, svcg = panel(spark, sf_dir, cluster=True)
    return loan_master(svcg, orig, bounded_loans=True).select(*chain_cols)


_stored: dict[str, str] = {}


def stored(spark, sf_dir: str) -> str:
    """The panel as plain Parquet and as delimited text, written once before any timing."""
    if sf_dir not in _stored:
        base = scratch_path(spark, "bench")
        orig, svcg = panel(spark, sf_dir, cluster=True)
        orig.write.parquet(f"{base}/orig")
        svcg.write.parquet(f"{base}/svcg")
        for df, spec, name in ((orig, ORIG_SPEC, "orig"), (svcg, SVCG_SPEC, "svcg")):
            (df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c) for c, _ in spec])
             .write.option("sep", "|").csv(f"{base}/text/{name}"))
        PanelTable(spark, f"{base}/table").append(svcg)
        MasterStore(spark, f"{base}/store").load(svcg, "all")
        _stored[sf_dir] = base
    return _stored[sf_dir]


def master_from_parquet(spark, sf_dir: str, bounded: bool = False):
    base = stored(spark, sf_dir)
    return loan_master(spark.read.parquet(f"{base}/svcg"), spark.read.parquet(f"{base}/orig"), bounded_loans=bounded)


def master_from_buckets(spark, sf_dir: str):
    base = stored(spark, sf_dir)
    return PanelTable(spark, f"{base}/table").master(spark.read.parquet(f"{base}/orig"))


def master_from_state(spark, sf_dir: str):
    base = stored(spark, sf_dir)
    return MasterStore(spark, f"{base}/store").master(spark.read.parquet(f"{base}/orig"))


def master_from_text(spark, sf_dir: str):
    base = stored(spark, sf_dir)
    orig, svcg, _ = read_feeds(spark, f"{base}/text/orig", f"{base}/text/svcg")
    return loan_master(svcg, orig)


# Beside the registered queries: the master from stored files, so that the shuffle of the panel counts.
FILES = {"loan_master_parquet": master_from_parquet,
         "loan_master_parquet_bounded": lambda spark, sf: master_from_parquet(spark, sf, bounded=True),
         "loan_master_text": master_from_text, "loan_master_buckets": master_from_buckets,
         "loan_master_state": master_from_state}

COMPARE = {"loan_master_one_pass": one_pass_master, "loan_master_join_chain": join_chain_master}


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    (QUERIES.get(name) or FILES.get(name) or COMPARE[name])(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="loanlife-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    if any(n in FILES for n in names):
        stored(spark, sf_dir)
    for n in names:  # warm-up: JIT, file listing, Python imports
        run(spark, n, sf_dir)
    times = {n: round(statistics.median(run(spark, n, sf_dir) for _ in range(repeat)), 3) for n in names}
    shape = {}
    if os.environ.get("BENCH_SHAPES", "0") == "1":  # opt-in: the join chain takes minutes
        for n in COMPARE:  # warm-up, then median, interleaved to share the machine's noise
            run(spark, n, sf_dir)
        runs = {n: [] for n in COMPARE}
        for _ in range(repeat):
            for n in COMPARE:
                runs[n].append(run(spark, n, sf_dir))
        shape = {n: round(statistics.median(v), 3) for n, v in runs.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "plan_shape_comparison": shape,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
