"""The registered queries as SQL for DuckDB, over views with the names of the tables.

What is added to a value before it is rounded is explained at ``registered.rounded``.
"""

from __future__ import annotations

from textwrap import dedent, indent

ORACLES: dict[str, str] = {}

# Clusters and figures of a report, as in the usage report plan.
_CLUSTERS = ("arm", "amd", "gpu")
_FIGURES = {
    "CompletedJobs": ("job_count", "outcome = 'COMPLETED'"),
    "FailedJobs": ("job_count", "outcome <> 'COMPLETED'"),
    "Jobs": ("job_count", "agency <> 'LOCAL'"),
    "JobsEuroHPC": ("job_count", "agency = 'EHPC'"),
    "usedhours": ("total_secs", "agency <> 'LOCAL'"),
    "usedhoursEuroHPC": ("total_secs", "agency = 'EHPC'"),
}


def _with(*parts: tuple[str, str], body: str) -> str:
    ctes = ",\n".join(f"{name} AS (\n{indent(dedent(sql).strip(), '    ')}\n)" for name, sql in parts)
    return f"WITH {ctes}\n{dedent(body).strip()}"


# Job records

JOBS = ("jobs", """
    SELECT o_orderkey AS job_id,
           CAST(floor(o_totalprice) AS BIGINT) % 86400 AS elapsed,
           1 + o_custkey % 8 AS nnodes,
           1 + o_custkey % 128 AS cpus,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'normal-arm'
                                WHEN '2-HIGH' THEN 'normal-a100-40'
                                WHEN '3-MEDIUM' THEN 'dev-a100-80'
                                ELSE 'normal-x86' END AS part_name,
           CASE o_custkey % 3 WHEN 0 THEN concat('f', o_custkey)
                              WHEN 1 THEN concat('ee', o_custkey)
                              ELSE concat('x', o_custkey) END AS account,
           CASE o_orderstatus WHEN 'F' THEN 'COMPLETED'
                              WHEN 'O' THEN 'FAILED'
                              ELSE concat('CANCELLED by ', o_custkey) END AS state,
           CASE o_orderkey % 4 WHEN 0 THEN NULL
                               WHEN 1 THEN ''
                               WHEN 2 THEN concat('billing=1,gres/gpu=', 1 + o_orderkey % 5)
                               ELSE 'billing=1' END AS tres,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS period
    FROM orders""")

CLASSIFIED = ("classified", """
    SELECT *, elapsed * vnodes AS job_seconds
    FROM (
        SELECT *,
               CASE WHEN state = 'COMPLETED' THEN 'COMPLETED' ELSE 'FAILED' END AS outcome,
               CASE WHEN part_name LIKE '%arm%' THEN 'arm'
                    WHEN part_name LIKE '%a100%' THEN 'gpu'
                    ELSE 'amd' END AS cluster,
               CASE WHEN account LIKE 'f%' THEN 'FCT'
                    WHEN account LIKE 'ee%' THEN 'EHPC'
                    ELSE 'LOCAL' END AS agency,
               CASE WHEN part_name NOT LIKE '%a100%' THEN nnodes
                    WHEN tres IS NULL OR tres = '' THEN nnodes
                    WHEN regexp_matches(tres, 'gres/gpu=[0-9]+')
                        THEN CAST(regexp_extract(tres, 'gres/gpu=([0-9]+)', 1) AS BIGINT)
                    ELSE nnodes * 4 END AS vnodes
        FROM jobs
    ) c""")

CUBE = ("usage", """
    SELECT period, cluster, agency, outcome,
           count(*) AS job_count, CAST(sum(job_seconds) AS BIGINT) AS total_secs
    FROM classified
    GROUP BY period, cluster, agency, outcome""")

REPORTS = ("reports", "SELECT DISTINCT period AS report FROM jobs")

PERIOD_MAP = ("period_map", """
    SELECT r.report, t.tag, p.report AS period
    FROM reports r
    CROSS JOIN (VALUES (''), ('Trimester'), ('Year')) t(tag)
    JOIN (SELECT DISTINCT report FROM (
              SELECT CAST(make_date(year(report), m, 1) AS DATE) AS report
              FROM reports CROSS JOIN range(1, 13) months(m))) p
      ON year(p.report) = year(r.report)
     AND month(p.report) <= month(r.report)
     AND month(p.report) >= CASE t.tag WHEN '' THEN month(r.report)
                                       WHEN 'Trimester' THEN month(r.report) - 2
                                       ELSE 1 END""")

_SUMS = ",\n".join(
    f"           sum(CASE WHEN cluster = '{c}' AND {part} THEN {measure} END) AS {c}{figure}"
    for c in _CLUSTERS
    for figure, (measure, part) in _FIGURES.items()
)
TOTALS = ("totals", f"""
    SELECT report, tag, count(cluster) > 0 AS any_jobs,
{_SUMS}
    FROM period_map LEFT JOIN usage USING (period)
    GROUP BY report, tag""")

_BASE = (JOBS, CLASSIFIED, CUBE, REPORTS, PERIOD_MAP, TOTALS)


def _value(cluster: str, figure: str, measure: str) -> str:
    known = f"coalesce(CAST({cluster}{figure} AS DOUBLE), 0)"
    return f"{known} / 3600" if measure == "total_secs" else known


def _tag_report(tag: str) -> str:
    rows = "\nUNION ALL\n".join(
        f"SELECT report, '{c}' AS cluster, '{figure}' AS metric,"
        f" round({_value(c, figure, measure)} + 1e-9, 6) AS value FROM totals WHERE tag = '{tag}'"
        for c in _CLUSTERS
        for figure, (measure, _) in _FIGURES.items()
    )
    return _with(*_BASE, body=rows)


ORACLES["usage_cube"] = _with(JOBS, CLASSIFIED, body="""
    SELECT period, cluster, agency, outcome,
           count(*) AS job_count, CAST(sum(job_seconds) AS BIGINT) AS total_secs
    FROM classified
    GROUP BY period, cluster, agency, outcome""")
ORACLES["usage_report_month"] = _tag_report("")
ORACLES["usage_report_trimester"] = _tag_report("Trimester")
ORACLES["usage_report_year"] = _tag_report("Year")


def _text(cluster: str, figure: str, measure: str) -> str:
    column = f"{cluster}{figure}"
    if measure == "job_count":
        return f"CAST(coalesce(CAST({column} AS BIGINT), 0) AS VARCHAR)"
    text = f"CAST(CAST({column} AS DOUBLE) / 3600 AS VARCHAR)"
    if figure == "usedhours":
        return f"coalesce({text}, CASE WHEN any_jobs THEN '0.0' ELSE '0' END)"
    return f"coalesce({text}, '0')"


CALENDAR = ("calendar", """
    SELECT report,
           strftime(report, '%d/%m/%Y') || ' - ' || last AS month_range,
           strftime(quarter, '%d/%m/%Y') || ' - ' || last AS quarter_range,
           strftime(january, '%d/%m/%Y') || ' - ' || last AS year_range,
           strftime(report, '%B') AS month_name,
           strftime(report, '%b') AS month_abbreviation,
           CAST(year(report) AS INTEGER) AS year,
           CAST(date_diff('day', report, next) AS INTEGER) AS days,
           CAST(date_diff('day', quarter, next) AS INTEGER) AS quarter_days,
           CAST(date_diff('day', january, next) AS INTEGER) AS year_days,
           CAST(date_diff('day', report, next) * 24 AS INTEGER) AS available_hours,
           CAST(date_diff('day', quarter, next) * 24 AS INTEGER) AS quarter_available_hours,
           CAST(date_diff('day', january, next) * 24 AS INTEGER) AS year_available_hours
    FROM (
        SELECT report,
               CAST(report + INTERVAL 1 MONTH AS DATE) AS next,
               strftime(last_day(report), '%d/%m/%Y') AS last,
               make_date(year(report), 1, 1) AS january,
               make_date(year(report), greatest(month(report) - 2, 1), 1) AS quarter
        FROM reports
    ) d""")

_HEADER = {
    "reportPeriod": "month_range",
    "reportPeriodTrimester": "quarter_range",
    "reportPeriodYear": "year_range",
    "reportMonth": "month_name",
    "reportYear": "CAST(year AS VARCHAR)",
    "armnodes": "'1632'",
    "amdnodes": "'500'",
    "gpunodes": "'132'",
    "percentaviail": "'0.8'",
    "eurohpcavail": "'0.35'",
    "ndays": "CAST(days AS VARCHAR)",
    "ndaysTrimester": "CAST(quarter_days AS VARCHAR)",
    "ndaysYear": "CAST(year_days AS VARCHAR)",
    "monthhours": r"'{\inteval{\ndays * 24}}'",
    "hoursTrimester": r"'{\inteval{\ndaysTrimester * 24}}'",
    "hoursYear": r"'{\inteval{\ndaysYear * 24}}'",
}
_PARAM_ROWS = "\nUNION ALL\n".join(
    [f"SELECT report, '{k}' AS key, {v} AS value FROM calendar" for k, v in _HEADER.items()]
    + [
        f"SELECT report, '{c}{figure}' || tag AS key, {_text(c, figure, measure)} AS value FROM totals"
        for c in _CLUSTERS
        for figure, (measure, _) in _FIGURES.items()
    ]
)
PARAMS = ("params", _PARAM_ROWS)

for _name in ("usage_report_params", "usage_report_multipass", "usage_report_direct"):
    ORACLES[_name] = _with(*_BASE, CALENDAR, PARAMS, body="SELECT report, key, value FROM params")

ORACLES["report_lines"] = _with(*_BASE, CALENDAR, PARAMS, (
    "lines", r"SELECT report, '\def\' || key || '{' || value || '}' AS line FROM params"
), body=r"""
    SELECT report, line,
           split_part(substr(line, 6), '{', 1) AS key,
           substr(line, position('{' IN line) + 1, length(line) - position('{' IN line) - 1) AS value
    FROM lines""")

ORACLES["reconcile_reports"] = _with(*_BASE, CALENDAR, PARAMS, ("copy", """
    SELECT report, key,
           CASE WHEN key LIKE 'armusedhours%'
                    THEN CAST(TRY_CAST(value AS DOUBLE) * CAST(1.0005 AS DOUBLE) AS VARCHAR)
                WHEN key LIKE 'gpuusedhours%'
                    THEN CAST(TRY_CAST(value AS DOUBLE) * CAST(1.01 AS DOUBLE) AS VARCHAR)
                WHEN key = 'reportMonth' THEN upper(value)
                ELSE value END AS value
    FROM params WHERE key NOT LIKE '%FailedJobsTrimester'
    UNION ALL
    SELECT report, 'armracks' AS key, value FROM params WHERE key = 'armnodes'
    UNION ALL
    SELECT report, key, '31' AS value FROM params WHERE key = 'amdnodes'"""),
    ("single", """
    SELECT report, key, max(value) AS value, count(DISTINCT value) > 1 AS several
    FROM copy GROUP BY report, key"""),
    ("joined", """
    SELECT report, key, a.value AS l, b.value AS r, coalesce(several, false) AS several,
           a.key IS NULL AS no_left, b.key IS NULL AS no_right,
           abs(TRY_CAST(a.value AS DOUBLE) - TRY_CAST(b.value AS DOUBLE))
               / nullif(abs(TRY_CAST(a.value AS DOUBLE)), 0) AS error
    FROM params a FULL JOIN single b USING (report, key)"""), body="""
    SELECT report, key, l AS left_value, r AS right_value,
           round(error + 1e-12, 9) AS relative_error,
           CASE WHEN several THEN 'duplicate'
                WHEN no_right THEN 'missing'
                WHEN no_left THEN 'extra'
                WHEN l = r THEN 'equal'
                WHEN error <= 0.001 THEN 'within tolerance'
                ELSE 'changed' END AS verdict
    FROM joined""")

ORACLES["reconcile_variants"] = _with(*_BASE, CALENDAR, PARAMS, body="""
    SELECT count(*) AS equal, CAST(0 AS BIGINT) AS within_tolerance, CAST(0 AS BIGINT) AS changed,
           CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra,
           CAST(0 AS BIGINT) AS duplicate, true AS acceptable
    FROM params""")

ORACLES["reporting_periods"] = _with(JOBS, REPORTS, CALENDAR, body="SELECT * FROM calendar")
ORACLES["period_months"] = _with(
    JOBS, REPORTS, PERIOD_MAP, body="SELECT report, tag, period FROM period_map"
)


def _classified(body: str) -> str:
    return _with(JOBS, CLASSIFIED, body=body)


ORACLES["completed_by_cluster"] = _classified("""
    SELECT outcome, cluster, count(*) AS job_count FROM classified GROUP BY outcome, cluster""")
ORACLES["nonlocal_hours_by_cluster"] = _classified("""
    SELECT cluster, round(CAST(sum(job_seconds) AS DOUBLE) / 3600 + 1e-9, 6) AS used_hours
    FROM classified WHERE agency <> 'LOCAL' GROUP BY cluster""")
ORACLES["nonlocal_jobs_by_cluster"] = _classified("""
    SELECT cluster, count(*) AS job_count
    FROM classified WHERE agency <> 'LOCAL' GROUP BY cluster""")
ORACLES["ehpc_jobs"] = _classified("""
    SELECT agency, cluster, count(*) AS job_count
    FROM classified WHERE agency = 'EHPC' GROUP BY agency, cluster""")
ORACLES["ehpc_sums"] = _classified("""
    SELECT agency, cluster,
           CAST(sum(job_id) AS BIGINT) AS sum_jobidraw,
           CAST(sum(elapsed) AS BIGINT) AS sum_elapsedraw,
           CAST(sum(nnodes) AS BIGINT) AS sum_nnodes,
           CAST(sum(cpus) AS BIGINT) AS sum_alloccpus,
           CAST(sum(vnodes) AS BIGINT) AS sum_vnodes,
           CAST(sum(job_seconds) AS BIGINT) AS sum_job_seconds
    FROM classified WHERE agency = 'EHPC' GROUP BY agency, cluster""")
ORACLES["jobs_by_normalised_state"] = _with(JOBS, body="""
    SELECT regexp_replace(state, 'CANCELLED(.*)', 'CANCELLED') AS state, count(*) AS job_count
    FROM jobs GROUP BY 1""")
ORACLES["gpu_share_nodes"] = _with(JOBS, body="""
    SELECT job_id,
           CASE WHEN part_name LIKE '%a100%' THEN (cpus + 31) // 32 ELSE nnodes END AS nodes
    FROM jobs""")
ORACLES["virtual_nodes"] = _classified("""
    SELECT job_id, cluster, agency, outcome, vnodes, job_seconds FROM classified""")
ORACLES["safe_cast_nodes"] = _with(JOBS, body="""
    SELECT job_id, TRY_CAST(substr(account, 2) AS BIGINT) AS number FROM jobs""")
ORACLES["new_since_snapshot"] = _with(JOBS, body="""
    SELECT job_id, period FROM jobs
    WHERE job_id NOT IN (SELECT job_id FROM jobs WHERE period < DATE '2000-01-01')""")

ORACLES["file_periods"] = """
SELECT o_orderkey AS job_id,
       CASE WHEN o_orderkey % 7 = 0 THEN 'other_' || strftime(o_orderdate, '%b') || '.txt'
            ELSE 'jobs_' || strftime(o_orderdate, '%b') || '.v2.txt' END AS file_name,
       CASE WHEN o_orderkey % 7 <> 0 THEN make_date(1996, month(o_orderdate), 1) END AS period
FROM orders"""

# Measurements

RUNS = ("runs", """
    SELECT *, row_number() OVER (
               PARTITION BY compiler, model, quantization, prompt ORDER BY event_id) AS run
    FROM (
        SELECT event_id,
               concat('c', user_id % 4) AS compiler,
               event_type AS model,
               concat('q', event_id % 2) AS quantization,
               concat('p', event_id % 3) AS prompt,
               value AS ttft,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) + 1 AS tpot,
               user_id * 1000000 + event_id AS mem,
               CAST(1 << CAST(user_id % 4 AS INTEGER) AS INTEGER) AS thread_count
        FROM events
    ) src""")

_CONFIG = "compiler, model, quantization, prompt"


def _stats(prefix: str = "", digits: bool = True) -> str:
    def column(call: str, m: str) -> str:
        if not digits:
            return f"{call}({m})"
        return f"round({call}({m}) + 1e-5, 2)" if m == "mem" else f"round({call}({m}) + 1e-9, 6)"

    return ", ".join(
        f"{column('avg', m)} AS {prefix}{m}_mean, {column('stddev_samp', m)} AS {prefix}{m}_stdev"
        for m in ("ttft", "tpot", "mem")
    )


def _rank(option: str, by: str, metrics: tuple[str, ...], source: str, where: str = "true") -> tuple:
    means = ", ".join(f"avg({m}) AS {m}_mean" for m in metrics)
    ratios = ", ".join(
        f"{m}_mean / min({m}_mean) OVER (PARTITION BY {by}) AS {m}_ratio" for m in metrics
    )
    return (
        ("means", f"SELECT {option}, {by}, {means} FROM {source} WHERE {where} GROUP BY {option}, {by}"),
        ("ratios", f"SELECT {option}, {ratios} FROM means"),
    )


def _geomeans(option: str, metrics: tuple[str, ...]) -> str:
    columns = ", ".join(
        f"round(exp(avg(ln({m}_ratio))) + 1e-9, 6) AS {m}_geomean,"
        f" count(*) - count({m}_ratio) AS {m}_left_out"
        for m in metrics
    )
    return f"SELECT {option}, {columns} FROM ratios GROUP BY {option}"


ORACLES["config_stats"] = _with(RUNS, body=f"""
    SELECT {_CONFIG}, {_stats()} FROM runs WHERE run > 1 AND run <= 6 GROUP BY {_CONFIG}""")
ORACLES["rank_options"] = _with(
    RUNS,
    *_rank("compiler", "model, quantization, prompt", ("ttft", "tpot"), "runs"),
    body=_geomeans("compiler", ("ttft", "tpot")),
)
ORACLES["rank_quantizations"] = _with(
    RUNS,
    *_rank("quantization", "compiler, model, prompt", ("ttft", "tpot", "mem"), "runs"),
    body=_geomeans("quantization", ("ttft", "tpot", "mem")),
)
ORACLES["cold_run_rank"] = _with(
    RUNS,
    *_rank("compiler", "model, quantization, prompt", ("ttft",), "runs", "run = 1"),
    body=_geomeans("compiler", ("ttft",)),
)
ORACLES["best_option"] = _with(
    RUNS,
    *_rank("compiler", "model, quantization, prompt", ("ttft", "tpot"), "runs"),
    ("ranked", _geomeans("compiler", ("ttft", "tpot"))),
    body="SELECT compiler, tpot_geomean FROM ranked ORDER BY tpot_geomean, compiler LIMIT 1",
)

_PAIR_KEYS = "compiler, model, prompt"


def _side(q: str, digits: bool) -> tuple[str, str]:
    return (
        q,
        f"SELECT {_PAIR_KEYS}, {_stats(q + '_', digits)} FROM runs"
        f" WHERE quantization = '{q}' GROUP BY {_PAIR_KEYS}",
    )


ORACLES["paired_compare"] = _with(
    RUNS, _side("q0", True), _side("q1", True),
    body=f"SELECT * FROM q0 JOIN q1 USING ({_PAIR_KEYS})",
)


def _t_row(metric: str) -> str:
    return (
        f"SELECT '{metric}' AS metric, count(q0_{metric}_mean) AS n_a, count(q1_{metric}_mean) AS n_b,"
        f" avg(q0_{metric}_mean) AS mean_a, avg(q1_{metric}_mean) AS mean_b,"
        f" var_samp(q0_{metric}_mean) AS var_a, var_samp(q1_{metric}_mean) AS var_b FROM pairs"
    )


# The p-value by Simpson's rule: the t density between -|t| and |t|, taken from one.
ORACLES["t_test_stat"] = _with(
    RUNS, _side("q0", False), _side("q1", False),
    ("pairs", f"SELECT * FROM q0 JOIN q1 USING ({_PAIR_KEYS})"),
    ("samples", _t_row("ttft") + "\nUNION ALL\n" + _t_row("tpot")),
    ("tests", """
    SELECT *, n_a + n_b - 2 AS df,
           (mean_a - mean_b) / sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / (n_a + n_b - 2)
                                    * (1.0 / n_a + 1.0 / n_b)) AS t
    FROM samples"""),
    ("density", """
    SELECT metric, i, abs(t) / 2000 AS step,
           exp(lgamma((df + 1) / 2.0) - lgamma(df / 2.0)) / sqrt(df * pi())
               * power(1 + power(abs(t) * i / 2000, 2) / df, -(df + 1) / 2.0) AS f
    FROM tests CROSS JOIN range(0, 2001) steps(i)"""),
    ("areas", """
    SELECT metric, sum(f * step / 3 * CASE WHEN i IN (0, 2000) THEN 1
                                           WHEN i % 2 = 1 THEN 4 ELSE 2 END) AS area
    FROM density GROUP BY metric"""),
    body="""
    SELECT metric, n_a, n_b, round(mean_a + 1e-9, 6) AS mean_a, round(mean_b + 1e-9, 6) AS mean_b,
           round(t + 1e-9, 6) AS t, df, round(1 - 2 * area + 1e-9, 6) AS p_value
    FROM tests JOIN areas USING (metric)""")


def _variants(digits: bool) -> tuple[str, str]:
    stats = _stats(digits=digits)
    return ("variants", f"""
    SELECT {_PAIR_KEYS}, '8T FIXED' AS threads, {stats} FROM runs
    WHERE quantization = 'q0' AND run > 1 AND run <= 6 GROUP BY {_PAIR_KEYS}
    UNION
    SELECT {_PAIR_KEYS}, concat(thread_count, 'T VARIED') AS threads, {stats} FROM runs
    WHERE quantization = 'q1' AND run > 1 AND run <= 6 GROUP BY {_PAIR_KEYS}, thread_count""")


ORACLES["variant_union"] = _with(RUNS, _variants(True), body="SELECT * FROM variants")
ORACLES["variant_rank"] = _with(RUNS, _variants(False), ("ratios", """
    SELECT threads,
           ttft_mean / min(ttft_mean) OVER (PARTITION BY model, prompt) AS ttft_ratio,
           tpot_mean / min(tpot_mean) OVER (PARTITION BY model, prompt) AS tpot_ratio
    FROM variants"""), body=_geomeans("threads", ("ttft", "tpot")))
ORACLES["property_check"] = _with(RUNS, body="""
    SELECT model, count(*) AS measurement_count,
           CAST(sum(CASE WHEN (run = 1 AND tpot > 50) OR (run > 1 AND tpot <= 50)
                         THEN 1 ELSE 0 END) AS BIGINT) AS property_applies
    FROM runs GROUP BY model""")

ERRORS = ("errors", f"""
    SELECT {_CONFIG}, run - 1 AS warmup_runs,
           var_samp(ttft) OVER w / count(*) OVER w AS mse
    FROM runs
    WINDOW w AS (PARTITION BY {_CONFIG} ORDER BY run
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    QUALIFY mse IS NOT NULL""")
LAGGED = ("lagged", f"""
    SELECT *, lag(mse) OVER (PARTITION BY {_CONFIG} ORDER BY warmup_runs) AS previous_mse
    FROM errors""")

ORACLES["trailing_mse"] = _with(RUNS, ERRORS, LAGGED, body=f"""
    SELECT {_CONFIG}, warmup_runs, round(mse + 1e-9, 6) AS mse, round(previous_mse + 1e-9, 6) AS previous_mse
    FROM lagged""")
ORACLES["mser_quotient"] = _with(RUNS, ERRORS, LAGGED, body="""
    SELECT warmup_runs, round(exp(avg(ln(previous_mse / mse))) + 1e-9, 6) AS mse_quotient_geomean,
           CAST(count(*) FILTER (WHERE mse = 0) AS BIGINT) AS left_out
    FROM lagged WHERE previous_mse IS NOT NULL
    GROUP BY warmup_runs""")

# Run profiles

ORACLES["job_records"] = """
SELECT o_orderkey AS job_id, o_orderpriority AS name, CAST(o_orderdate AS VARCHAR) AS submitted,
       CAST(NULL AS VARCHAR) AS completed, o_custkey % 9 AS num_tasks, o_orderkey * 10 + n AS stage_id
FROM orders JOIN range(1, 5) stages(n) ON n <= 1 + o_custkey % 4
WHERE o_orderkey % 11 <> 0
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 11 = 0"""
ORACLES["stage_records"] = """
SELECT o_orderkey AS stage_id, CAST(o_orderkey % 3 = 0 AS INTEGER) AS attempt_id,
       'COMPLETE' AS status, CAST(4 AS BIGINT) AS num_tasks,
       o_custkey * 100 + CAST(o_orderkey % 3 = 0 AS INTEGER) AS shuffle_write_bytes
FROM orders"""
ORACLES["task_records"] = """
SELECT o_orderkey AS stage_id, CAST(attempt AS INTEGER) AS attempt_id,
       o_orderkey * 10 + n AS task_id, o_custkey * n AS duration_ms,
       o_custkey * n AS shuffle_write_bytes, n AS shuffle_write_records,
       o_orderkey + CASE WHEN n > 1 THEN n ELSE 0 END AS shuffle_read_bytes,
       2 * n AS shuffle_read_records
FROM orders
JOIN range(0, 2) attempts(attempt) ON attempt = 0 OR o_orderkey % 3 = 0
JOIN range(1, 5) tasks(n) ON n <= 1 + (o_custkey + attempt) % 4"""

# An order's job has two stages; which of their attempts the log knows, and what it knows of tasks.

_LOG = ("log", """
    SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS state, epoch_ms(CAST(o_orderdate AS TIMESTAMP)) AS born,
           CAST(CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS last_attempt,
           o_orderstatus <> 'P' AS stages_end, o_orderstatus <> 'P' AND o_orderkey % 11 <> 0 AS ends
    FROM orders""")
_LOG_JOBS = ("log_jobs", """
    SELECT k AS job_id, 'stage ' || (2 * k + 1) AS name,
           CASE WHEN NOT ends THEN 'RUNNING' WHEN state = 'F' THEN 'SUCCEEDED' ELSE 'FAILED' END AS status,
           born AS started, CASE WHEN ends THEN born + c END AS ended, (2 * k) || ' ' || (2 * k + 1) AS stage_ids, 2 * (c % 9) AS num_tasks
    FROM log""")
_LOG_TASK_EVENTS = ("log_task_events", """
    SELECT 2 * k AS stage_id, last_attempt AS attempt_id, k * 10 + n AS task_id,
           CASE WHEN NOT ended THEN 'RUNNING' WHEN q = 13 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
           1000 * n AS started, CASE WHEN ended THEN 1000 * n + q END AS ended,
           CASE WHEN ended THEN q * 1000 END AS duration_ms, CASE WHEN ended THEN q END AS shuffle_write_bytes,
           CASE WHEN ended THEN n END AS shuffle_write_records,
           CASE WHEN ended THEN k + CASE WHEN n > 1 THEN n ELSE 0 END END AS shuffle_read_bytes,
           CASE WHEN ended THEN 2 * n END AS shuffle_read_records
    FROM (SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS n, CAST(l_quantity AS BIGINT) AS q,
                 l_orderkey % 5 > 0 OR l_linenumber > 1 AS ended FROM lineitem) JOIN log USING (k)""")
# Line items share their numbers: of the events of one task the latest counts.
_LOG_TASKS = ("log_tasks", """
    SELECT stage_id, attempt_id, task_id, unnest(max({'ended': ended, 'failed': status = 'FAILED', 'status': status, 'started': started, 'duration_ms': duration_ms,
           'shuffle_write_bytes': shuffle_write_bytes, 'shuffle_write_records': shuffle_write_records,
           'shuffle_read_bytes': shuffle_read_bytes, 'shuffle_read_records': shuffle_read_records}))
    FROM log_task_events GROUP BY stage_id, attempt_id, task_id""")
_LOG_STAGES = ("log_stages", f"""
    SELECT 2 * k AS stage_id, last_attempt AS attempt_id, CAST(last_attempt + 1 AS BIGINT) AS num_attempts,
           CASE WHEN stages_end THEN 'COMPLETE' ELSE 'ACTIVE' END AS status, born + 10 + last_attempt AS started,
           CASE WHEN stages_end THEN born + 500 + c END AS ended, c % 9 AS num_tasks,
           {", ".join(f"coalesce({c}, 0) AS {c}" for c in ("shuffle_write_bytes", "shuffle_write_records", "shuffle_read_bytes", "shuffle_read_records"))}
    FROM log LEFT JOIN (
        SELECT stage_id, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("shuffle_write_bytes", "shuffle_write_records", "shuffle_read_bytes", "shuffle_read_records"))}
        FROM log_task_events GROUP BY stage_id) t ON t.stage_id = 2 * k
    UNION ALL
    SELECT 2 * k + 1, CASE WHEN k % 3 = 0 THEN 0 END, CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END,
           CASE WHEN k % 3 <> 0 THEN CASE WHEN ends THEN 'SKIPPED' ELSE 'PENDING' END
                WHEN NOT stages_end THEN 'ACTIVE' WHEN k % 7 = 0 THEN 'FAILED' ELSE 'COMPLETE' END,
           CASE WHEN k % 3 = 0 THEN born + 10 END, CASE WHEN k % 3 = 0 AND stages_end THEN born + 500 + c END,
           CASE WHEN k % 3 = 0 THEN c % 9 ELSE 0 END, 0, 0, 0, 0
    FROM log""")
ORACLES["event_log_jobs"] = _with(_LOG, _LOG_JOBS, body="SELECT * FROM log_jobs")
ORACLES["event_log_tasks"] = _with(_LOG, _LOG_TASK_EVENTS, _LOG_TASKS, body="SELECT * EXCLUDE (failed) FROM log_tasks")
ORACLES["event_log_stages"] = _with(_LOG, _LOG_TASK_EVENTS, _LOG_STAGES, body="SELECT * FROM log_stages")
ORACLES["event_log_records"] = _with(_LOG, _LOG_JOBS, _LOG_TASK_EVENTS, _LOG_TASKS, _LOG_STAGES, ("of_orders", """
    SELECT count(*) AS job_starts, count(*) FILTER (WHERE ends) AS job_ends,
           count(*) FILTER (WHERE stages_end AND NOT ends) AS broken_lines, count(*) FILTER (WHERE k % 9 = 0) AS other_events,
           CAST(sum(1 + last_attempt + CAST(k % 3 = 0 AS INTEGER)) AS BIGINT) AS stage_starts,
           CAST(sum(CASE WHEN stages_end THEN 1 + last_attempt + CAST(k % 3 = 0 AS INTEGER) ELSE 0 END) AS BIGINT) AS stage_ends
    FROM log"""), ("of_tasks", "SELECT count(*) AS task_starts, count(ended) AS task_ends FROM log_task_events"), ("lines", """
    SELECT broken_lines + other_events + job_starts + job_ends + stage_starts + stage_ends + task_starts + task_ends AS lines, *
    FROM of_orders, of_tasks"""), body="""
    SELECT 'line' AS kind, status, n FROM (UNPIVOT lines ON COLUMNS(*) INTO NAME status VALUE n)
    UNION ALL SELECT 'job', status, count(*) FROM log_jobs GROUP BY status
    UNION ALL SELECT 'stage', status, count(*) FROM log_stages GROUP BY status
    UNION ALL SELECT 'task', status, count(*) FROM log_tasks GROUP BY status""")

STAGES = ("stages", """
    SELECT o_custkey AS job_id, o_orderkey AS stage_id, o_orderstatus = 'P' AS skipped,
           CASE WHEN o_orderstatus = 'P' THEN 0 ELSE floor(o_totalprice * 10) / 1000 END
               AS execution_time,
           1 + o_custkey % 8 AS num_tasks,
           coalesce(ran, 0) AS num_nonskipped_tasks,
           coalesce(worked, 0) AS working_time,
           o_custkey * 7 AS shuffle_write_bytes,
           o_custkey AS shuffle_write_records,
           CAST(floor(o_totalprice) AS BIGINT) AS shuffle_read_bytes,
           o_orderkey % 1000 AS shuffle_read_records
    FROM orders LEFT JOIN (
        SELECT l_orderkey, count(*) AS ran, sum(l_quantity) AS worked
        FROM lineitem GROUP BY l_orderkey
    ) t ON l_orderkey = o_orderkey""")
_SHUFFLE = (
    "shuffle_write_bytes",
    "shuffle_write_records",
    "shuffle_read_bytes",
    "shuffle_read_records",
)
_RATIO = (
    "round(CASE WHEN execution_time = 0 THEN 1.0 ELSE working_time / (execution_time * 8) END + 1e-9, 6)"
    " AS working_time_ratio"
)
_SHUFFLE_SUMS = ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in _SHUFFLE)
SPARK_JOBS = ("spark_jobs", f"""
    SELECT c_custkey AS job_id, c_name AS name,
           TIMESTAMP '1995-01-01' + to_seconds(c_custkey) AS started,
           TIMESTAMP '1995-01-01' + to_seconds(c_custkey + CAST(floor(abs(c_acctbal)) AS BIGINT)) AS ended,
           CAST(floor(abs(c_acctbal)) AS DOUBLE) AS execution_time,
           CAST(c_nationkey AS BIGINT) AS num_tasks,
           coalesce(a.working_time, 0) AS working_time,
           coalesce(num_stages, 0) AS num_stages,
           CAST(0 AS BIGINT) AS num_unknown_stages,
           coalesce(num_nonskipped_stages, 0) AS num_nonskipped_stages,
           coalesce(a.num_nonskipped_tasks, 0) AS num_nonskipped_tasks,
           {", ".join(f"coalesce({c}, 0) AS {c}" for c in _SHUFFLE)},
           min_tasks AS min_nonskipped_tasks_per_stage,
           max_tasks AS max_nonskipped_tasks_per_stage
    FROM customer LEFT JOIN (
        SELECT job_id, count(*) AS num_stages,
               CAST(sum(CASE WHEN skipped THEN 0 ELSE 1 END) AS BIGINT) AS num_nonskipped_stages,
               CAST(sum(num_nonskipped_tasks) AS BIGINT) AS num_nonskipped_tasks,
               sum(working_time) AS working_time, {_SHUFFLE_SUMS},
               min(CASE WHEN NOT skipped THEN num_nonskipped_tasks END) AS min_tasks,
               max(CASE WHEN NOT skipped THEN num_nonskipped_tasks END) AS max_tasks
        FROM stages GROUP BY job_id
    ) a ON a.job_id = c_custkey""")

ORACLES["stage_rollup"] = _with(STAGES, body=f"""
    SELECT stage_id, skipped, round(execution_time + 1e-9, 6) AS execution_time, num_tasks,
           num_nonskipped_tasks, round(working_time + 1e-9, 6) AS working_time,
           {", ".join(_SHUFFLE)}, {_RATIO}
    FROM stages""")
ORACLES["job_rollup"] = _with(STAGES, SPARK_JOBS, body=f"""
    SELECT * REPLACE (epoch_ms(started) AS started, epoch_ms(ended) AS ended), {_RATIO}
    FROM spark_jobs""")
ORACLES["query_rollup"] = _with(STAGES, SPARK_JOBS, ("total", f"""
    SELECT count(*) AS num_jobs,
           {", ".join(
               f"CAST(sum({c}) AS BIGINT) AS {c}"
               for c in ("num_stages", "num_unknown_stages", "num_nonskipped_stages", "num_tasks", "num_nonskipped_tasks")
           )},
           sum(working_time) AS working_time, {_SHUFFLE_SUMS},
           CAST(date_diff('second', min(started), max(ended)) AS DOUBLE) AS execution_time,
           min(min_nonskipped_tasks_per_stage) AS min_nonskipped_tasks_per_stage,
           max(max_nonskipped_tasks_per_stage) AS max_nonskipped_tasks_per_stage
    FROM spark_jobs"""), body=f"SELECT *, {_RATIO} FROM total")

ORACLES["run_statistics"] = _with(RUNS, body="\nUNION ALL\n".join(
    f"SELECT {_CONFIG}, '{m}' AS metric, round(avg({m}) + {nudge}, {digits}) AS mean,"
    f" round(stddev_samp({m}) + {nudge}, {digits}) AS stdev FROM runs WHERE run > 1 GROUP BY {_CONFIG}"
    for m, nudge, digits in (("ttft", "1e-9", 6), ("tpot", "1e-9", 6), ("mem", "1e-5", 2))
))
ORACLES["first_run"] = _with(RUNS, body=f"SELECT {_CONFIG}, mem, tpot FROM runs WHERE run = 2")

ORACLES["counter_phases"] = _with(("samples", """
    SELECT user_id, (n - 1) // 3 AS run, (n - 1) % 3 AS phase, cpu, clock
    FROM (
        SELECT user_id,
               row_number() OVER w AS n,
               sum(value) OVER w AS cpu,
               date_diff('microsecond', TIMESTAMP '2024-01-01', ts) / 1e6 AS clock
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ) n"""), ("wide", """
    SELECT user_id, run,
           max(CASE WHEN phase = 0 THEN cpu END) AS c0, max(CASE WHEN phase = 0 THEN clock END) AS t0,
           max(CASE WHEN phase = 1 THEN cpu END) AS c1, max(CASE WHEN phase = 1 THEN clock END) AS t1,
           max(CASE WHEN phase = 2 THEN cpu END) AS c2, max(CASE WHEN phase = 2 THEN clock END) AS t2
    FROM samples GROUP BY user_id, run"""), body="""
    SELECT user_id, run,
           round(c1 - c0 + 1e-9, 6) AS load_cpu, round(c2 - c1 + 1e-9, 6) AS process_cpu,
           round(c2 - c0 + 1e-9, 6) AS total_cpu,
           round(t1 - t0 + 1e-9, 6) AS load_clock, round(t2 - t1 + 1e-9, 6) AS process_clock,
           round(t2 - t0 + 1e-9, 6) AS total_clock,
           round((c1 - c0) / nullif(t1 - t0, 0) + 1e-9, 6) AS load_cpu_rate,
           round((c2 - c1) / nullif(t2 - t1, 0) + 1e-9, 6) AS process_cpu_rate,
           round((c2 - c0) / nullif(t2 - t0, 0) + 1e-9, 6) AS total_cpu_rate
    FROM wide""")

ORACLES["scaling_table"] = _with(RUNS, ("means", """
    SELECT model AS variant, thread_count AS threads, avg(ttft) AS mean_time,
           stddev_samp(ttft) AS stdev_time, avg(tpot / 100) AS ratio
    FROM runs GROUP BY model, thread_count"""), body="""
    SELECT variant, threads, round(mean_time + 1e-9, 6) AS mean_time, round(stdev_time + 1e-9, 6) AS stdev_time,
           round(ratio + 1e-9, 6) AS working_time_ratio,
           round(first_value(mean_time) OVER (PARTITION BY variant ORDER BY threads) / mean_time + 1e-9, 6)
               AS speedup,
           round(100 * (1 - ratio) + 1e-9, 6) AS idle
    FROM means""")

# Cost model

MODELS = ("models", """
    SELECT *, bytes * 1.1e0 / (818e0 * 1e9) * 1000 + 0.5e0 AS ideal
    FROM (
        SELECT concat(p_name, ' ', p_partkey) AS name,
               CAST(p_size AS DOUBLE) * 1e8
                   * CASE p_partkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 4 ELSE 8 END / 8 AS bytes,
               p_retailprice / 10 AS observed
        FROM part
    ) p""")
_FITS = {
    "none": "1e0",
    "mse": "sum(ideal * observed) / sum(ideal * ideal)",
    "geomean": "exp(avg(ln(observed / ideal)))",
}


def _fitted(fit: str) -> tuple:
    return (
        MODELS,
        ("fitted", f"SELECT {_FITS[fit]} AS k FROM models"),
        ("predicted", """
        SELECT *, bytes * 1.1e0 / (818e0 * 1e9) * 1000 * k + 0.5e0 AS pred
        FROM models CROSS JOIN fitted"""),
    )


for _fit in _FITS:
    ORACLES[f"fit_{_fit}"] = _with(*_fitted(_fit), body="""
    SELECT round(max(k) + 1e-9, 6) AS k, round(avg(power(pred - observed, 2)) + 1e-9, 6) AS mse FROM predicted""")
ORACLES["model_report"] = _with(*_fitted("mse"), body="""
    SELECT name, round(bytes / 1073741824 + 1e-9, 6) AS memory_gib, round(k + 1e-9, 6) AS k,
           round(pred + 1e-9, 6) AS predicted_ms, round(observed + 1e-9, 6) AS observed_ms,
           round(observed / ideal + 1e-9, 6) AS ratio,
           round(abs(pred - observed) / observed * 100 + 1e-9, 6) AS error_percent
    FROM predicted""")

# Scores

SCORES = ("scores", """
    SELECT lang AS prompt, source AS evaluator, quality + toxic AS score,
           CASE WHEN n_chars < 1000 THEN 'small' WHEN n_chars < 5000 THEN 'medium'
                ELSE 'large' END AS size
    FROM labels JOIN documents USING (doc_id)""")
ORACLES["score_totals"] = _with(SCORES, body="""
    SELECT CASE WHEN grouping(size) = 1 THEN 'Total' ELSE size END AS size,
           CASE WHEN grouping(prompt) = 1 THEN 'Total' ELSE prompt END AS prompt,
           CASE WHEN grouping(evaluator) = 1 THEN 'Total' ELSE evaluator END AS evaluator,
           CAST(sum(score) AS BIGINT) AS total
    FROM scores GROUP BY CUBE (size, prompt, evaluator)""")
_SCORE_COLUMNS = ", ".join(
    f"CAST(sum(CASE WHEN evaluator = 'src{n}' THEN score ELSE 0 END) AS BIGINT) AS src{n}"
    for n in range(20)
)
_EVALUATORS = ", ".join(f"'src{n}'" for n in range(20))
ORACLES["score_table"] = _with(SCORES, body=f"""
    SELECT CASE WHEN grouping(size) = 1 THEN 'Total' ELSE size END AS size,
           {_SCORE_COLUMNS},
           CAST(sum(CASE WHEN coalesce(evaluator, '') IN ({_EVALUATORS}) THEN 0 ELSE score END) AS BIGINT) AS "Other",
           CAST(sum(score) AS BIGINT) AS "Total"
    FROM scores GROUP BY ROLLUP (size)""")

# Requests and responses

BODIES = ("bodies", """
    SELECT conv_id, turn, to_json({
               'timings': {'prompt_n': length(text), 'predicted_n': turn, 'cache_n': conv_id % 7,
                           'prompt_ms': length(text) * 0.5e0,
                           'predicted_per_token_ms': 1 + turn * 0.25e0},
               'choices': [{'message': {'role': role, 'content': text}}]}) AS body
    FROM conversations""")
ORACLES["response_timings"] = _with(BODIES, body="""
    SELECT conv_id, turn,
           CAST(json_extract_string(body, '$.timings.prompt_n') AS INTEGER) AS prompt_n,
           CAST(json_extract_string(body, '$.timings.predicted_n') AS INTEGER) AS predicted_n,
           CAST(json_extract_string(body, '$.timings.cache_n') AS INTEGER) AS cache_n,
           round(CAST(json_extract_string(body, '$.timings.prompt_ms') AS DOUBLE)
                 + CAST(json_extract_string(body, '$.timings.predicted_per_token_ms') AS DOUBLE) + 1e-9, 6)
               AS ttft,
           round(CAST(json_extract_string(body, '$.timings.predicted_per_token_ms') AS DOUBLE) + 1e-9, 6)
               AS tpot
    FROM bodies""")
ORACLES["response_content"] = _with(BODIES, body="""
    SELECT conv_id, turn, json_extract_string(body, '$.choices[0].message.content') AS content
    FROM bodies""")
ORACLES["request_bodies"] = """
SELECT conv_id, turn, CAST(to_json({'messages': [{'role': 'user', 'content': text}],
                                    'seed': 0, 'max_tokens': 4096}) AS VARCHAR) AS request
FROM conversations"""

FILES = ("files", """
    SELECT event_id, concat('../models/', event_type, '-', 1 + user_id % 8, 'B-Instruct-',
               CASE event_id % 3 WHEN 0 THEN 'Q3_K_M' WHEN 1 THEN 'Q4_K_M' ELSE 'Q8_0' END,
               '.gguf') AS path
    FROM events""")
ORACLES["model_name_parts"] = _with(FILES, body=r"""
    SELECT event_id,
           regexp_replace(list_extract(string_split(path, '/'), -1), '-Q[0-9_KM]+\.gguf$', '') AS model,
           regexp_extract(list_extract(string_split(path, '/'), -1), '(Q[0-9_KM]+)', 1) AS quantization,
           list_extract(string_split(path, '/'), -1) AS file,
           list_extract(string_split(path, '/'), -2) AS directory
    FROM files""")
ORACLES["busy_cpu_time"] = _with(RUNS, body="""
    SELECT event_id, round((ttft * 10 * thread_count - tpot) / thread_count + 1e-9, 6) AS busy FROM runs""")


# Files: the same rows come back.

ORACLES["extract_usage_cube"] = ORACLES["inferred_usage_cube"] = ORACLES["usage_cube"]
ORACLES["report_files"] = ORACLES["usage_report_params"]
ORACLES["default_report"] = f"SELECT * FROM ({ORACLES['usage_report_params']}) WHERE report = DATE '1996-12-01'"
ORACLES["extract_period_jobs"] = _with(JOBS, body="""
    SELECT job_id || '_1' AS JobID, CAST(job_id AS INTEGER) AS JobIDRaw, elapsed * cpus * 1000 AS CPUTimeRAW, '1-02:03:04' AS TotalCPU, '0:0' AS ExitCode,
           nnodes || '.5' AS Reservation, nullif(tres, '') AS AllocTRES, period
    FROM jobs WHERE period = DATE '1996-02-01'""")
_TYPES = {
    **dict.fromkeys(("JobIDRaw", "ElapsedRaw", "AllocCPUS", "NNodes", "AllocNodes", "NCPUS"), "1"),
    **dict.fromkeys(("JobID", "Account", "Partition", "TotalCPU", "User", "ExitCode", "State"), "4"),
    "CPUTimeRAW": "max(CASE WHEN elapsed * cpus * 1000 > 2147483647 THEN 2 ELSE 1 END)",
    "Reservation": "CASE month(period) % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 4 END",
    "ReservationId": "CASE WHEN month(period) < 7 THEN 1 ELSE 2 END",
    "AllocTRES": "max(CASE WHEN coalesce(tres, '') = '' THEN 0 ELSE 4 END)",
}
ORACLES["inferred_columns"] = _with(JOBS, ("ranks", " UNION ALL ".join(f"SELECT period, '{name}' AS name, CAST({rank} AS INTEGER) AS rank FROM jobs GROUP BY period" for name, rank in _TYPES.items())), body="""
    SELECT period, name, ['INT', 'BIGINT', 'DOUBLE', 'STRING'][nullif(rank, 0)] AS type FROM ranks
    UNION ALL SELECT NULL, name, ['INT', 'BIGINT', 'DOUBLE', 'STRING'][nullif(max(rank), 0)] FROM ranks GROUP BY name""")
ORACLES["refreshed_usage"] = _with(JOBS, CLASSIFIED, body="""
    SELECT period, cluster, agency, outcome, count(*) AS job_count,
           CAST(sum(job_seconds + CASE WHEN period IN (DATE '1997-01-01', DATE '1997-02-01') THEN vnodes ELSE 0 END) AS BIGINT) AS total_secs
    FROM classified
    WHERE period <> DATE '1996-05-01' AND (period <> DATE '1995-03-01' OR state = 'COMPLETED')
    GROUP BY ALL""")
ORACLES["measurement_files"] = """
    SELECT 'c' || user_id % 4 AS compiler, event_type AS model, 'q' || event_id % 2 AS quantization, 'static' AS seeding, 'p' || event_id % 3 AS prompt,
           CAST(event_id AS INTEGER) AS run, CAST(event_id % 97 AS INTEGER) AS prompt_n, CAST(event_id % 7 AS INTEGER) AS predicted_n, 0 AS cache_n,
           value AS ttft, CAST(json_extract_string(props, '$.k') AS DOUBLE) + 1 AS tpot, user_id * 1000000 + event_id AS mem
    FROM events"""
_SPOKEN = ("spoken", """
    SELECT role AS prompt_type, CAST(conv_id AS VARCHAR) AS prompt_id, string_agg(text, chr(10) ORDER BY turn, text) AS text
    FROM conversations GROUP BY role, conv_id""")
ORACLES["prompt_files"] = _with(_SPOKEN, body="SELECT prompt_type, prompt_id, text FROM spoken")
ORACLES["response_files"] = _with(_SPOKEN, body="SELECT 'm' || length(prompt_id) AS model, prompt_type, prompt_id, text AS content FROM spoken")
ORACLES["job_documents"] = _with(STAGES, SPARK_JOBS, body="""
    SELECT j.job_id, name, num_stages, stage_id, skipped, s.num_tasks, s.num_nonskipped_tasks,
           round(s.working_time + 1e-9, 6) AS working_time, s.shuffle_read_bytes
    FROM spark_jobs j LEFT JOIN stages s ON s.job_id = j.job_id""")
