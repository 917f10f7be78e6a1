"""Registered queries for the generic operators, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlife.functions.exprs import (as_number, month_diff, ne_null_safe, nullsum, quarter_label,
                                      quarter_starts, rate_fallback, transition_label, vintage, waterfall)
from loanlife.operators import generic as G
from loanlife.operators.detail import PRIOR_COLUMNS
from loanlife.operators.links import page_links
from loanlife.plans import oracle as O
from loanlife.plans.queries import _detail, register
from loanlife.plans.sql_surface import sql_master
from loanlife.schema import SVCG_SPEC
from loanlife.session import scratch_path
from loanlife.sources import ingest, sink
from loanlife.sources.panel import ORIG_COLUMNS, SVCG_COLUMNS, dealt_panel, panel

# Event types of the events table.
EVENT_TYPES = ["view", "click", "purchase", "signup", "error"]

PANEL_SVCG_SPEC = [(c, dict(SVCG_SPEC)[c]) for c in SVCG_COLUMNS]
PANEL_ORIG_SPEC = [("id_loan", "string"), ("orign_qtr", "string"), ("orig_upb", "decimal(14,2)"),
                   ("int_rt", "decimal(6,3)"), ("fico", "int"), ("dt_first_pi", "int"),
                   ("orig_loan_term", "int"), ("zipcode", "string"), ("seller_name", "string")]


def _t(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _svcg(spark, sf):
    return panel(spark, sf)[1]


def _orig(spark, sf):
    return panel(spark, sf)[0]


def _events(spark, sf):
    return _t(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


def EV_ORDER():
    return [F.col("ts").asc(), F.col("event_id").asc()]


def EV_GROUP():
    """Group for users' lags: the event's month (never decreases along ts)."""
    return F.trunc("ts", "month")


def EV_ORDER_DESC():
    return [F.col("ts").desc(), F.col("event_id").desc()]

# --- sources / sinks ----------------------------------------------------------------


@register("io_roundtrip", f"{O.PANEL}\nSELECT * FROM svcg")
def q_io_roundtrip(spark, sf):
    path = scratch_path(spark, "io_roundtrip")
    sink.write_delimited(_svcg(spark, sf), path, header=True, compression="snappy")
    raw = ingest.read_delimited(spark, path, PANEL_SVCG_SPEC, header=True)
    return ingest.typed_parse(raw, PANEL_SVCG_SPEC)


@register("typed_parse", f"{O.PANEL}\nSELECT * FROM svcg")
def q_typed_parse(spark, sf):
    as_text = _svcg(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in SVCG_COLUMNS])
    return ingest.typed_parse(as_text, PANEL_SVCG_SPEC)


_FAULTY = {"period": ("delq_sts = '2'", "concat('P', period)"), "act_endg_upb": ("period % 12 = 5", "concat(act_endg_upb, '?')"),
           "id_loan": ("period % 100 = 7 AND delq_sts = '1'", "''")}


@register("quarantine", f"""{O.PANEL},
bad AS (SELECT CASE WHEN period % 100 = 7 AND delq_sts = '1' THEN NULL ELSE id_loan END AS id_loan,
               CASE WHEN delq_sts = '2' THEN concat('P', CAST(period AS VARCHAR)) END AS bad_period,
               CASE WHEN period % 12 = 5 AND act_endg_upb IS NOT NULL
                    THEN concat(CAST(act_endg_upb AS VARCHAR), '?') END AS bad_upb FROM svcg)
SELECT id_loan, 'period' AS column_name, bad_period AS value, r AS reason, count(*) AS n
FROM bad, (VALUES ('rejected'), ('missing')) t(r) WHERE bad_period IS NOT NULL GROUP BY ALL
UNION ALL
SELECT id_loan, 'act_endg_upb', bad_upb, 'rejected', count(*) FROM bad WHERE bad_upb IS NOT NULL GROUP BY ALL
UNION ALL
SELECT NULL, 'id_loan', NULL, 'missing', count(*) FROM bad WHERE id_loan IS NULL HAVING count(*) > 0""")
def q_quarantine(spark, sf):
    """The panel written as text with faults in three columns, loaded, and each fault listed with
    the loan in its record."""
    path, staged = scratch_path(spark, "faulty"), scratch_path(spark, "staged")
    text = _svcg(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in SVCG_COLUMNS])
    faulty = text.select(*[F.expr(f"CASE WHEN {_FAULTY[c][0]} THEN {_FAULTY[c][1]} ELSE {c} END").alias(c)
                           if c in _FAULTY else F.col(c) for c in SVCG_COLUMNS])
    sink.write_delimited(faulty, path, header=False, compression="snappy")
    ingest.load_feed(spark, path, PANEL_SVCG_SPEC, ("id_loan", "period"), staged)
    faults = ingest.quarantine(spark, staged)
    loan = F.nullif(F.split("record", r"\|")[0], F.lit("")).alias("id_loan")
    return ingest.quarantine(spark, staged).groupBy(loan, F.col("column").alias("column_name"), "value", "reason").agg(
        F.count(F.lit(1)).alias("n"))


@register("ingest_by_quarter", f"{O.PANEL}\nSELECT * FROM orig")
def q_ingest_by_quarter(spark, sf):
    path = scratch_path(spark, "by_quarter")
    orig = _orig(spark, sf)
    (orig.hint("rebalance", "orign_qtr").write.mode("overwrite").partitionBy("orign_qtr")
     .option("sep", "|").option("header", "false").csv(path))
    file_spec = [s for s in PANEL_ORIG_SPEC if s[0] != "orign_qtr"]
    raw = ingest.read_delimited(spark, path, file_spec, label="orign_qtr")
    return ingest.typed_parse(raw, PANEL_ORIG_SPEC).select(*ORIG_COLUMNS)


@register("append_quarters", f"{O.PANEL}\nSELECT * FROM orig")
def q_append_quarters(spark, sf):
    """Two batches appended, then the second written again: no row twice, none lost."""
    path = scratch_path(spark, "append")
    orig = _orig(spark, sf)
    early = F.coalesce(F.col("orign_qtr").endswith("1996") | F.col("orign_qtr").endswith("1997"), F.lit(False))
    ingest.append_partitioned(orig.where(early), path, mode="overwrite")
    ingest.append_partitioned(orig.where(~early), path)
    ingest.replace_quarters(orig.where(~early), path)
    return spark.read.parquet(path).select(*ORIG_COLUMNS)


@register("sql_surface", f"""{O.BASE},
last_row AS (SELECT id_loan, arg_max(struct_pack(c := cd_zero_bal, p := prior_upb, u := act_endg_upb), rn) AS t,
                    max(CASE WHEN flag_mod = 'Y' THEN 1 END) AS mod_ind
             FROM detail GROUP BY id_loan)
SELECT DISTINCT orig.id_loan,
  CASE WHEN t.c = '01' OR t.c = '06' THEN 1 END AS prepay_count,
  CASE WHEN t.c = '03' OR t.c = '09' THEN 1 END AS default_count,
  CASE WHEN t.c = '01' OR t.c = '06' THEN t.p END AS prepay_upb,
  CASE WHEN COALESCE(trim(t.c), '') = '' THEN t.u END AS rmng_upb, mod_ind
FROM orig LEFT JOIN last_row USING (id_loan)""")
def q_sql_surface(spark, sf):
    return sql_master(*dealt_panel(spark, sf)).select(
        "id_loan", "prepay_count", "default_count", "prepay_upb", "rmng_upb", "mod_ind")


@register("sql_surface_master", O.master_sql())
def q_sql_surface_master(spark, sf):
    return sql_master(*dealt_panel(spark, sf))


@register("sql_surface_full", O.master_sql())
def q_sql_surface_full(spark, sf):
    """SQL from the lags to the last select, by the registered SQL functions."""
    return sql_master(*panel(spark, sf, cluster=True), all_sql=True)


@register("page_links", """
WITH pieces AS (SELECT page_id, url, UNNEST(string_split(html, '<a href="')[2:]) AS p FROM pages),
links AS (SELECT page_id, url, split_part(p, '"', 1) AS href,
                 split_part(substr(p, strpos(p, '">') + 2), '</a>', 1) AS link_text FROM pieces),
sites AS (SELECT *, split_part(split_part(url, '?', 1), '#', 1) AS path,
                 list_aggregate(string_split(url, '/')[1:3], 'string_agg', '/') AS site FROM links)
SELECT page_id, link_text, href,
  CASE WHEN contains(href, '://') THEN href
       WHEN href[1] = '/' THEN site || href
       WHEN path = site THEN site || '/' || href
       ELSE list_aggregate(string_split(path, '/')[:-2], 'string_agg', '/') || '/' || href END AS link_url
FROM sites WHERE contains(link_text, 'the')""")
def q_page_links(spark, sf):
    return page_links(_t(spark, sf, "pages"), keyword="the")


# The whole pages table, and with it a listing page per origination quarter, as an index of quarterly files
# would look: each quarter's link in another spelling, besides links that the filter must not take.
_LISTING_KINDS = 4


@register("page_links_years", f"""{O.PANEL},
q AS (SELECT DISTINCT orign_qtr AS q, row_number() OVER (ORDER BY orign_qtr) - 1 AS i
      FROM (SELECT DISTINCT orign_qtr FROM orig)),
pieces AS (SELECT page_id, url, UNNEST(string_split(html, '<a href="')[2:]) AS p FROM pages),
links AS (SELECT page_id, url, split_part(p, '"', 1) AS href,
                 split_part(substr(p, strpos(p, '">') + 2), '</a>', 1) AS link_text FROM pieces)
SELECT page_id, link_text, href, split_part(url, '/', 1) || '//' || split_part(url, '/', 3) || href AS link_url
FROM links WHERE contains(link_text, 'historical') AND regexp_matches(link_text, '1993|1994|1995|1996')
UNION ALL
SELECT i AS page_id, 'historical data ' || q || ' full' AS link_text,
  CASE i % 4 WHEN 0 THEN 'data_' || q || '.zip' WHEN 1 THEN '/files/data_' || q || '.zip'
             WHEN 2 THEN '//cdn.example/data_' || q || '.zip' ELSE '?file=' || q END AS href,
  CASE i % 4 WHEN 0 THEN 'https://feeds.example/index/data_' || q || '.zip'
             WHEN 1 THEN 'https://feeds.example/files/data_' || q || '.zip'
             WHEN 2 THEN 'https://cdn.example/data_' || q || '.zip'
             ELSE 'https://feeds.example/index/list?file=' || q END AS link_url
FROM q WHERE q[3:] IN ('1993', '1994', '1995', '1996')""")
def q_page_links_years(spark, sf):
    quarters = _orig(spark, sf).select("orign_qtr").distinct().withColumn(
        "i", (F.row_number().over(Window.orderBy("orign_qtr")) - 1).cast("bigint"))
    q = F.col("orign_qtr")
    spellings = [
        F.format_string("<A data-href=\"/no\" HREF='data_%s.zip'>historical <b>data</b> %s full</A >", q, q),
        F.format_string("<a\n class=\"x>y\" href = \"/files/data_%s.zip\">historical data\n  %s <i>full</i></a>", q, q),
        F.format_string("<a href=//cdn.example/data_%s.zip>historical data <!-- > -->%s full</a>", q, q),
        F.format_string("<a href=\"?file=%s\"><span>historical data %s</span> full</a>", q, q)]
    own = F.element_at(F.array(*spellings), (F.col("i") % _LISTING_KINDS + 1).cast("int"))
    others = F.format_string("<a href=\"mailto:desk@feeds.example\">historical questions</a>"
                             "<a name=\"%s\">historical %s</a><a href=\"/s\">sample %s</a>", q, q, q)
    pages = quarters.select(F.col("i").alias("page_id"), F.lit("https://feeds.example/index/list?x=1#top").alias("url"),
                            F.concat(F.lit("<p>"), own, others, F.lit("</p>")).alias("html"))
    pages = _t(spark, sf, "pages").select("page_id", "url", "html").unionByName(pages)
    return page_links(pages, keyword="historical", year_from=1993, year_to=1996)


# --- cleaning, projections, filters ---------------------------------------------------

@register("dedupe_rows", "SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)")
def q_dedupe_rows(spark, sf):
    li = _t(spark, sf, "lineitem")
    return G.dedupe(G.union_all(li, li))


@register("drop_null_key", f"{O.PANEL}\nSELECT id_loan, period, cd_zero_bal, dt_zero_bal FROM svcg "
          "WHERE id_loan IS NOT NULL AND cd_zero_bal IS NOT NULL")
def q_drop_null_key(spark, sf):
    return G.drop_null_key(_svcg(spark, sf), ["id_loan", "cd_zero_bal"]).select(
        "id_loan", "period", "cd_zero_bal", "dt_zero_bal")


@register("struct_expand", f"{O.BASE}\nSELECT id_loan, period, {', '.join(PRIOR_COLUMNS)} FROM detail")
def q_struct_expand(spark, sf):
    packed = _detail(spark, sf).select("id_loan", "period", F.struct(*PRIOR_COLUMNS).alias("prior"))
    return packed.select("id_loan", "period", "prior.*")


@register("filter_eq", f"{O.PANEL}\nSELECT id_loan, period, flag_mod, modcost FROM svcg WHERE flag_mod = 'Y'")
def q_filter_eq(spark, sf):
    return _svcg(spark, sf).where(F.col("flag_mod") == "Y").select("id_loan", "period", "flag_mod", "modcost")


@register("filter_range", f"{O.PANEL}\nSELECT id_loan, period, cd_zero_bal FROM svcg "
          f"WHERE {O.NUM('cd_zero_bal')} BETWEEN 3 AND 9")
def q_filter_range(spark, sf):
    return _svcg(spark, sf).where(as_number("cd_zero_bal").between(3, 9)).select(
        "id_loan", "period", "cd_zero_bal")


@register("filter_in", f"{O.PANEL}\nSELECT id_loan, period, delq_sts, act_endg_upb FROM svcg "
          "WHERE delq_sts IN ('1','2','3') AND act_endg_upb IS NOT NULL AND act_endg_upb <> 0")
def q_filter_in(spark, sf):
    upb = F.col("act_endg_upb")
    return _svcg(spark, sf).where(F.col("delq_sts").isin("1", "2", "3") & ~(upb.isNull() | (upb == 0))
                                  ).select("id_loan", "period", "delq_sts", "act_endg_upb")


@register("filter_null_safe", f"{O.PANEL}\nSELECT id_loan, period, delq_sts, flag_mod FROM svcg "
          "WHERE delq_sts IS DISTINCT FROM 'R' AND flag_mod IS DISTINCT FROM 'Y'")
def q_filter_null_safe(spark, sf):
    return _svcg(spark, sf).where(ne_null_safe("delq_sts", "R") & ne_null_safe("flag_mod", "Y")).select(
        "id_loan", "period", "delq_sts", "flag_mod")


# --- joins ------------------------------------------------------------------------------

@register("join_inner", "SELECT l_orderkey, l_linenumber, l_quantity, o_custkey, o_orderpriority "
          "FROM lineitem, orders WHERE l_orderkey = o_orderkey")
def q_join_inner(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").drop("o_orderkey")


@register("join_three", "SELECT l_orderkey, l_linenumber, c_custkey, c_mktsegment, l_extendedprice "
          "FROM lineitem, orders, customer WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey")
def q_join_three(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
            .select("l_orderkey", "l_linenumber", "c_custkey", "c_mktsegment", "l_extendedprice"))


@register("first_by_min", "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() "
          "OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def q_first_by_min(spark, sf):
    return G.first_row(_events(spark, sf), "user_id", ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type", "value")


@register("first_by_min_ties", "SELECT e.user_id, e.event_id, e.event_type, e.value FROM events e "
          "JOIN (SELECT user_id, min(CAST(ts AS DATE)) AS d FROM events GROUP BY user_id) m "
          "ON e.user_id = m.user_id AND CAST(e.ts AS DATE) = m.d")
def q_first_by_min_ties(spark, sf):
    return G.first_rows_with_ties(_events(spark, sf), "user_id", F.to_date("ts")).select(
        "user_id", "event_id", "event_type", "value")


@register("semi_flagged", f"{O.PANEL}\nSELECT id_loan, period, flag_mod, act_endg_upb FROM svcg "
          "WHERE id_loan IN (SELECT id_loan FROM svcg WHERE flag_mod = 'Y')")
def q_semi_flagged(spark, sf):
    return G.keys_flagged(_svcg(spark, sf), "id_loan", F.col("flag_mod") == "Y").select(
        "id_loan", "period", "flag_mod", "act_endg_upb")


@register("left_chain", """SELECT o.o_orderkey, o.o_orderstatus, a.n_lines, a.sum_qty, r.n_returned
FROM orders o
LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines,
                  CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS sum_qty
           FROM lineitem GROUP BY l_orderkey) a ON o.o_orderkey = a.l_orderkey
LEFT JOIN (SELECT l_orderkey, count(*) AS n_returned FROM lineitem WHERE l_returnflag = 'R'
           GROUP BY l_orderkey) r ON o.o_orderkey = r.l_orderkey""")
def q_left_chain(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    return G.enrich(o, "o_orderkey", li, "l_orderkey", [
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("decimal(18,2)").alias("sum_qty"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.lit(1).cast("long"))).alias("n_returned"),
    ])


# --- aggregation ----------------------------------------------------------------------------

@register("agg_min", f"{O.PANEL}\nSELECT id_loan, min(period) AS min_period FROM svcg GROUP BY id_loan")
def q_agg_min(spark, sf):
    return _svcg(spark, sf).groupBy("id_loan").agg(F.min("period").alias("min_period"))


@register("agg_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def q_agg_distinct(spark, sf):
    return _events(spark, sf).select("user_id", "event_type").distinct()


@register("agg_count", "SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL "
          "SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
def q_agg_count(spark, sf):
    parts = [_t(spark, sf, t).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(t).alias("table_name"), "n") for t in ("orders", "lineitem", "events")]
    return G.union_all(*parts)


@register("first_by_bucket", "SELECT user_id, " + ", ".join(
    f"max(CASE WHEN event_type = '{t}' AND r = 1 THEN value END) AS first_{t}" for t in EVENT_TYPES)
    + " FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r "
      "FROM events) GROUP BY user_id")
def q_first_by_bucket(spark, sf):
    return G.first_by_bucket(_events(spark, sf), "user_id", ["ts", "event_id"], "event_type",
                             EVENT_TYPES, "value")


# --- windows -------------------------------------------------------------------------------

@register("lag1", "SELECT event_id, user_id, lag(event_type) OVER w AS prev_event_type, "
          "lag(value) OVER w AS prev_value FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def q_lag1(spark, sf):
    return G.with_lags(_events(spark, sf), "user_id", EV_ORDER(), {
        "prev_event_type": ("event_type", 1), "prev_value": ("value", 1)}, group=EV_GROUP()).select(
        "event_id", "user_id", "prev_event_type", "prev_value")


@register("lag2", "SELECT event_id, user_id, lag(event_type, 2) OVER w AS prev2_event_type, "
          "lag(value, 2) OVER w AS prev2_value FROM events "
          "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def q_lag2(spark, sf):
    return G.with_lags(_events(spark, sf), "user_id", EV_ORDER(), {
        "prev2_event_type": ("event_type", 2), "prev2_value": ("value", 2)}, group=EV_GROUP()).select(
        "event_id", "user_id", "prev2_event_type", "prev2_value")


@register("lag_runs", "SELECT event_id, user_id, row_number() OVER w AS rn, lag(event_type) OVER w AS prev_event_type, "
          "lag(value, 2) OVER w AS prev2_value FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def q_lag_runs(spark, sf):
    """Lags over sorted runs: no user and no month of a user has to fit in one task."""
    return G.lags_runs(_events(spark, sf), "user_id", ["ts", "event_id"], {
        "prev_event_type": ("event_type", 1), "prev2_value": ("value", 2)}).select(
        "event_id", "user_id", F.col("rn").cast("bigint").alias("rn"), "prev_event_type", "prev2_value")


_STATUS_ORDER = ["id_loan", "period", "act_endg_upb"] + [c for c in SVCG_COLUMNS if c not in ("id_loan", "period", "act_endg_upb")]


@register("status_spells", f"""{O.PANEL}
SELECT id_loan, period, delq_sts FROM (
  SELECT id_loan, period, delq_sts, row_number() OVER w AS r, lag(delq_sts) OVER w AS before FROM svcg
  WINDOW w AS (PARTITION BY id_loan ORDER BY {', '.join(c + ' NULLS FIRST' for c in _STATUS_ORDER[1:])}))
WHERE r = 1 OR before IS DISTINCT FROM delq_sts""")
def q_status_spells(spark, sf):
    """First row of each spell of one status: rows like their neighbour go, the same status later on stays."""
    # Rows alike in the first four columns of the order have one status and one result: which comes first is not seen, so
    # that the other columns need neither be made nor moved.
    order = _STATUS_ORDER[:_STATUS_ORDER.index("delq_sts") + 1]
    return G.drop_adjacent(_svcg(spark, sf).select(*order), order, compare=["id_loan", "delq_sts"]).select(
        "id_loan", "period", "delq_sts")


@register("window_first", "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() "
          "OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def q_window_first(spark, sf):
    return G.row_number_first(_events(spark, sf), "user_id", EV_ORDER()).select(
        "user_id", "event_id", "event_type", "value")


@register("window_last", "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() "
          "OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def q_window_last(spark, sf):
    return G.row_number_first(_events(spark, sf), "user_id", EV_ORDER_DESC()).select(
        "user_id", "event_id", "event_type", "value")


# --- sorts, set operations ------------------------------------------------------------------

@register("sort_output", f"{O.PANEL}\nSELECT id_loan, period, delq_sts FROM svcg ORDER BY id_loan, period")
def q_sort_output(spark, sf):
    return _svcg(spark, sf).select("id_loan", "period", "delq_sts").orderBy("id_loan", "period")


_UNION_COLS = "id_loan, period, delq_sts, delq_sts_new, cd_zero_bal"
_UNION_SQL = (f"SELECT {_UNION_COLS} FROM detail WHERE delq_sts_new = '6' UNION ALL "
              f"SELECT {_UNION_COLS} FROM detail WHERE (cd_zero_bal = '03' OR delq_sts = 'R') "
              f"AND NOT COALESCE({O.NUM('delq_sts_new')} >= 6, FALSE)")


def _union_conds():
    severe = F.coalesce(as_number("delq_sts_new") >= 6, F.lit(False))
    early = F.coalesce((F.col("cd_zero_bal") == "03") | (F.col("delq_sts") == "R"), F.lit(False)) & ~severe
    return [F.col("delq_sts_new") == "6", early]


def _union_detail(spark, sf):
    return _detail(spark, sf).select(*[c.strip() for c in _UNION_COLS.split(",")])


@register("union_all", f"{O.BASE}\n{_UNION_SQL}")
def q_union_all(spark, sf):
    # D180 rows UNION ALL pre-D180 default rows of the same detail, in one pass
    return G.union_of_filters(_union_detail(spark, sf), _union_conds())


@register("union_distinct", f"{O.BASE}\nSELECT DISTINCT * FROM ({_UNION_SQL})")
def q_union_distinct(spark, sf):
    return G.union_of_filters(_union_detail(spark, sf), _union_conds(), distinct=True)


# --- scalar functions ------------------------------------------------------------------------

@register("waterfall", f"{O.BASE}\nSELECT id_loan, period, "
          "COALESCE(NULLIF(act_endg_upb, 0), NULLIF(prior_upb, 0), orig_upb) AS upb FROM detail")
def q_waterfall(spark, sf):
    return _detail(spark, sf).select("id_loan", "period",
                                     waterfall("act_endg_upb", "prior_upb", "orig_upb").alias("upb"))


@register("rate_fallback", f"{O.BASE}\nSELECT id_loan, period, "
          "COALESCE(NULLIF(new_int_rt, 0), prior_int_rt) AS current_int_rt FROM detail")
def q_rate_fallback(spark, sf):
    return _detail(spark, sf).select("id_loan", "period",
                                     rate_fallback("new_int_rt", "prior_int_rt").alias("current_int_rt"))


@register("month_diff", f"{O.PANEL}\nSELECT id_loan, period, "
          f"CAST({O.MONTH_INDEX('period')} - {O.MONTH_INDEX('dt_lst_pi')} AS INT) AS months_since_lst_pi FROM svcg")
def q_month_diff(spark, sf):
    return _svcg(spark, sf).select("id_loan", "period",
                                   month_diff("dt_lst_pi", "period").alias("months_since_lst_pi"))


@register("nullsum", f"{O.PANEL}\nSELECT id_loan, period, CAST("
          f"{O.NULLSUM('mi_recoveries', 'non_mi_recoveries')} AS DECIMAL(15,2)) AS recoveries FROM svcg")
def q_nullsum(spark, sf):
    return _svcg(spark, sf).select("id_loan", "period", nullsum("mi_recoveries", "non_mi_recoveries")
                                   .cast("decimal(15,2)").alias("recoveries"))


@register("vintage", f"{O.PANEL}\nSELECT id_loan, SUBSTR(id_loan, 3, 2) AS vintage FROM orig")
def q_vintage(spark, sf):
    return _orig(spark, sf).select("id_loan", vintage("id_loan").alias("vintage"))


@register("transition_label", f"{O.BASE}\nSELECT id_loan, period, "
          "TRIM(CONCAT(COALESCE(prior_delq_sts, ''), ' to ', COALESCE(delq_sts, ''))) AS delq_string, "
          "TRIM(CONCAT(COALESCE(CAST(prior_period AS VARCHAR), ''), ' to ', "
          "COALESCE(CAST(period AS VARCHAR), ''))) AS month_string FROM detail")
def q_transition_label(spark, sf):
    return _detail(spark, sf).select(
        "id_loan", "period", transition_label("prior_delq_sts", "delq_sts").alias("delq_string"),
        transition_label("prior_period", "period").alias("month_string"))


@register("quarter_label", "SELECT o_orderkey, CONCAT('Q', CAST(quarter(o_orderdate) AS VARCHAR), "
          "CAST(year(o_orderdate) AS VARCHAR)) AS orign_qtr FROM orders")
def q_quarter_label(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", quarter_label("o_orderdate").alias("orign_qtr"))


@register("quarter_series", """SELECT CAST(d AS DATE) AS qtr_start,
  CONCAT('Q', CAST(quarter(d) AS VARCHAR), CAST(year(d) AS VARCHAR)) AS orign_qtr
FROM (SELECT UNNEST(generate_series(date_trunc('quarter', min(o_orderdate)),
                                    date_trunc('quarter', max(o_orderdate)), INTERVAL 3 MONTH)) AS d
      FROM orders)""")
def q_quarter_series(spark, sf):
    span = _t(spark, sf, "orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    qs = span.select(F.explode(quarter_starts("lo", "hi")).alias("qtr_start"))
    return qs.select("qtr_start", quarter_label("qtr_start").alias("orign_qtr"))
