"""Fixture views: the ledger's inputs derived from the driver's tables.

Each view is one SELECT that Spark and DuckDB both accept. They read whole tables; conditions
pick by what a row says, never by its id.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

TABLES = ("documents", "events", "pages", "conversations")
AS_OF = "2025-01-09 00:00:00"


def _id(n: str) -> str:
    return f"CAST(10000000 + ({n} * 7919) % 89999999 AS STRING)"


DOC = _id("doc_id")
# Documents 0-3, 5-8, 10-13 … are attempted; the last fifth of the numbers names no document.
ATTEMPTED = _id("CAST(floor(event_id / 10) + floor(event_id / 40) AS BIGINT)")

VIEWS = {
    "fx_manifest": f"""
        SELECT {DOC} AS pmid, 'pdfs/' || substr({DOC}, 1, 3) || '/' || {DOC} || '.pdf' AS pdf_path,
               CAST(n_chars * 1500 AS BIGINT) AS file_size, doc_id AS row_idx
        FROM {{documents}}""",
    # As typed by hand: padded, with blank ids and blank paths.
    "fx_raw_manifest": """
        SELECT CASE WHEN row_idx % 9 = 4 THEN '  ' ELSE ' ' || pmid || chr(9) END AS pmid,
               CASE WHEN row_idx % 7 = 3 THEN '' ELSE pdf_path || ' ' END AS pdf_path, row_idx
        FROM fx_manifest""",
    "fx_raw_attempts": f"""
        SELECT CASE WHEN value < 0.5 THEN ' ' ELSE pmid || ' ' END AS pmid,
               'pdfs/' || substr(pmid, 1, 3) || '/' || pmid || '.pdf' AS pdf_path,
               CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'pending' ELSE 'completed' END AS status,
               CASE WHEN event_type IN ('error', 'signup') THEN ''
                    ELSE 'out/' || substr(pmid, 1, 3) || '/' || pmid || '/auto/' || pmid || '_content_list.json' END AS json_path,
               CASE WHEN event_type IN ('error', 'signup') OR value < 30 THEN ' '
                    ELSE 'out/' || substr(pmid, 1, 3) || '/' || pmid || '/auto/' || pmid || '.md' END AS md_path,
               CASE WHEN event_type = 'error' AND value < 20 THEN '' WHEN value > 300 THEN 'nan'
                    WHEN value < 0.3 THEN 'n/a' ELSE CAST(value AS STRING) END AS processing_time,
               CASE WHEN event_type <> 'error' THEN ''
                    WHEN value < 20 THEN 'PDF file not found'
                    WHEN value < 60 THEN 'No output files generated'
                    WHEN value < 90 THEN 'RuntimeError: "bad, page"' || chr(10) || 'at line 2'
                    ELSE 'Processing timeout' END AS error_msg,
               ts AS processed_at,
               'chunk_' || lpad(CAST(user_id AS STRING), 5, '0') || '.csv' AS chunk_file,
               event_id AS row_idx
        FROM (SELECT *, {ATTEMPTED} AS pmid FROM {{events}}) e""",
    "fx_attempts": f"""
        SELECT {ATTEMPTED} AS pmid,
               CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'pending' ELSE 'completed' END AS status,
               CASE WHEN event_type = 'error' AND value < 20 THEN NULL ELSE value END AS processing_time,
               ts AS processed_at,
               'chunk_' || lpad(CAST(user_id AS STRING), 5, '0') || '.csv' AS chunk_file,
               event_id AS row_idx,
               CASE user_id % 5 WHEN 0 THEN 'cn23' WHEN 1 THEN 'cn30' WHEN 2 THEN 'cn41' WHEN 3 THEN 'cn42' END AS node_prefix,
               CASE event_id % 5 WHEN 0 THEN 'pipeline' WHEN 1 THEN 'hybrid-auto-engine' WHEN 2 THEN 'vlm-auto-engine' WHEN 3 THEN 'nova-engine' END AS backend
        FROM {{events}}""",
    # Output files: kind by event type, layout by user; content lists only of the slower half.
    "fx_files": f"""
        SELECT path, max(length) AS length, max(pmid) AS pmid
        FROM (SELECT pmid, dir || CASE WHEN event_type = 'error' THEN 'images/' || CASE WHEN user_id % 4 = 1 THEN 'sub/' ELSE '' END || 'fig' || CAST(user_id AS STRING) || '.jpg'
                                       ELSE CASE WHEN user_id % 10 = 7 THEN 'paper' ELSE pmid END ||
                                            CASE event_type WHEN 'view' THEN '_content_list.json' WHEN 'signup' THEN '_content_list.json' WHEN 'click' THEN '.md'
                                                            WHEN 'purchase' THEN '_middle.json' ELSE '_model.json' END END AS path,
                     CAST(floor(value * 1024) AS BIGINT) AS length
              FROM (SELECT event_type, user_id, value, pmid,
                           'out/' || CASE WHEN user_id % 5 = 4 THEN '' ELSE substr(pmid, 1, 3) || '/' END || pmid || '/' ||
                           CASE WHEN user_id % 5 = 3 THEN pmid || '/' ELSE '' END ||
                           CASE WHEN user_id % 11 = 3 THEN '' WHEN user_id % 3 = 1 THEN 'hybrid_auto/' WHEN user_id % 7 = 6 THEN 'vlm/' ELSE 'auto/' END AS dir
                    FROM (SELECT *, {ATTEMPTED} AS pmid FROM {{events}}) e
                    WHERE event_type <> 'view' OR value > 60) d
              UNION ALL
              SELECT {DOC}, 'out/' || substr({DOC}, 1, 3) || '/' || {DOC} || '/auto/' || {DOC} || '_content_list.json', n_chars
              FROM {{documents}} WHERE n_chars < 800) f
        GROUP BY path""",
    "fx_outputs": """
        SELECT DISTINCT pmid FROM fx_files WHERE right(path, 18) = '_content_list.json'""",
    "fx_registry": f"""
        SELECT {_id('d.doc_id')} AS pmid,
               'pdfs/' || substr({_id('d.doc_id')}, 1, 3) || '/' || {_id('d.doc_id')} || '.pdf' AS pdf_path,
               CASE WHEN d.doc_id % 10 >= 7 THEN 'old/' || {_id('d.doc_id')} || '.json' END AS json_path,
               CAST(NULL AS STRING) AS md_path,
               CASE WHEN d.doc_id % 97 = 5 THEN NULL WHEN d.doc_id % 10 < 6 THEN 'pending'
                    WHEN d.doc_id % 10 < 8 THEN 'failed' ELSE 'completed' END AS status,
               CASE WHEN d.doc_id % 10 = 6 THEN 'Processing timeout after a very long wait for the first of all the pages' END AS error_msg,
               CAST(CASE WHEN d.doc_id % 10 < 6 OR d.doc_id % 20 = 19 THEN NULL ELSE e.value END AS FLOAT) AS processing_time,
               CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE CAST(d.n_chars * 1500 AS BIGINT) END AS file_size,
               coalesce(e.ts, TIMESTAMP '2024-01-01 00:00:00') AS created_at, coalesce(e.ts, TIMESTAMP '2024-01-01 00:00:00') AS updated_at
        FROM {{documents}} d LEFT JOIN (
            SELECT CAST(floor(event_id / 10) AS BIGINT) AS doc, max(value) AS value, max(ts) AS ts FROM {{events}} GROUP BY 1
        ) e ON e.doc = d.doc_id""",
    # Input files: those of short documents are gone, web pages came in anew, some without an id.
    "fx_listing": f"""
        SELECT 'pdfs/' || substr({DOC}, 1, 3) || '/' || {DOC} || '.pdf' AS path, CAST(n_chars * 1500 AS BIGINT) AS length
        FROM {{documents}} WHERE n_chars >= 500
        UNION ALL
        SELECT 'pdfs/new/PMC' || CAST(7000000 + page_id AS STRING) || '.PDF', CAST(length(html) AS BIGINT) FROM {{pages}}
        UNION ALL
        SELECT 'pdfs/copy/1234567' || CAST(7000000 + page_id AS STRING) || '.pdf', CAST(1 AS BIGINT) FROM {{pages}}
        UNION ALL
        SELECT 'pdfs/new/x' || CAST(page_id AS STRING) || '.pdf', CAST(0 AS BIGINT) FROM {{pages}}""",
    "fx_timings": """
        SELECT CASE user_id % 6 WHEN 0 THEN 'A100' WHEN 1 THEN 'V100x' WHEN 2 THEN 'V100' WHEN 3 THEN 'P100'
                                WHEN 4 THEN 'K80' ELSE 'CPU' END AS gpu_type,
               CASE event_id % 5 WHEN 0 THEN 'pipeline' WHEN 1 THEN 'hybrid' WHEN 2 THEN 'vlm' WHEN 3 THEN 'nova-engine' END AS backend,
               CASE WHEN user_id % 6 >= 4 AND event_id % 5 > 0 THEN NULL ELSE value END AS seconds
        FROM {events}""",
    "fx_elements": f"""
        SELECT {_id('conv_id')} AS pmid, turn AS seq,
               CASE role WHEN 'user' THEN 'text' WHEN 'assistant' THEN 'list' ELSE 'header' END AS type,
               text, turn % 3 AS page_idx,
               CASE conv_id % 5 WHEN 0 THEN 'pipeline' WHEN 1 THEN 'hybrid-auto-engine' WHEN 2 THEN 'vlm' WHEN 3 THEN 'nova-engine' END AS backend
        FROM {{conversations}}""",
    # Each text run four times, with formulas at its commas: set in several ways, in some runs truly different ones, between all
    # kinds of delimiters; where sentences begin with a dollar sign, prose gets between them.
    "fx_runs": f"""
        SELECT pmid, backend, run,
               CASE WHEN n % 7 = 0 THEN replace(replace(text, ', ', formula), '. ', '. $') ELSE replace(text, ', ', formula) END AS text
        FROM (SELECT pmid, backend, run, n, text,
                     CASE n % 5 WHEN 0 THEN ' $' || k || '$ ' WHEN 1 THEN ' $$' || k || '$$ '
                                WHEN 2 THEN ' ' || chr(92) || '(' || k || chr(92) || ') ' WHEN 3 THEN ' ' || chr(92) || '[' || k || chr(92) || '] '
                                ELSE ' ' || chr(92) || '$5 $' || chr(92) || 'text {{{{in  {{{{x y}}}} }}}} ' || k || chr(92) || 'operatorname * {{{{a}}}} ' ||
                                     chr(92) || 'alpha b$ ' END AS formula
              FROM (SELECT {_id('conv_id * 100 + turn')} AS pmid, text, length(text) AS n, run,
                           CASE conv_id % 3 WHEN 0 THEN 'pipeline' WHEN 1 THEN 'hybrid' ELSE 'vlm' END AS backend,
                           chr(92) || CASE WHEN run = 0 THEN 'mathbf {{{{ K }}}} ^ {{{{ + }}}}' WHEN run = 1 THEN 'mathrm{{{{K}}}}^{{{{+}}}}'
                                           WHEN run = 2 THEN 'mathtt K^{{{{+}}}}' WHEN length(text) % 3 = 0 THEN 'mathcal{{{{K}}}}^{{{{+}}}}'
                                           ELSE 'mathbb{{{{ K }}}}^{{{{+}}}}' END AS k
                    FROM {{conversations}} CROSS JOIN (VALUES (0), (1), (2), (3)) AS v(run)) t) s""",
    # Elements of three runs: the second loses and alters some, the third repeats some and has its boxes a little off.
    "fx_element_runs": f"""
        SELECT {_id('conv_id')} AS pmid, CASE conv_id % 3 WHEN 0 THEN 'pipeline' WHEN 1 THEN 'hybrid' END AS backend, run,
               CAST(turn * 2 + again AS BIGINT) AS seq, role AS type,
               CASE WHEN run = 1 AND length(text) % 4 = 1 THEN text || '.' ELSE text END AS text,
               CAST(turn * 10 AS DOUBLE) + CASE WHEN run = 2 THEN CAST(length(text) % 5 AS DOUBLE) * 0.5 ELSE CAST(0 AS DOUBLE) END AS x,
               CASE WHEN length(text) % 6 > 0 THEN CAST(length(text) AS DOUBLE) END AS height
        FROM {{conversations}} CROSS JOIN (VALUES (0, 0), (1, 0), (2, 0), (2, 1)) AS v(run, again)
        WHERE NOT (run = 1 AND length(text) % 4 = 3) AND (again = 0 OR length(text) % 3 = 0)""",
    "fx_logs": """
        SELECT user_id AS chunk_no, event_id AS line_no,
               CASE event_type
                 WHEN 'signup' THEN '[' || CAST(event_id % 40 + 1 AS STRING) || '/40] Skipping ' ||
                      CAST(10000000 + event_id AS STRING) || ' (already processed)'
                 WHEN 'purchase' THEN 'running on cn' || CAST(2300 + user_id % 4 * 700 AS STRING) || ', try ' || CAST(event_id AS STRING)
                 ELSE '[' || CAST(event_id % 40 + 1 AS STRING) || '/40] ' || CASE WHEN event_type = 'error' THEN '✗' ELSE '✓' END ||
                      ' ' || CAST(10000000 + event_id AS STRING) || ' (' || CAST(CAST(floor(value) AS BIGINT) AS STRING) || '.5s)' END AS line
        FROM {events}""",
    "fx_telemetry": """
        SELECT 'cn' || CAST(2300 + user_id AS STRING) AS node,
               ' ' || CASE user_id % 3 WHEN 0 THEN 'A100' WHEN 1 THEN 'V100' ELSE 'Tesla K80 Dual Accelerator' END AS gpu_name,
               CASE WHEN event_type = 'error' THEN '[N/A]' ELSE ' ' || CAST(event_id % 101 AS STRING) END AS utilization,
               CAST(30 + user_id % 50 AS STRING) AS temperature, CAST(value AS STRING) AS power,
               ' ' || CAST(event_id % 16000 AS STRING) AS memory_used, ' 16280' AS memory_total
        FROM {events}""",
    "fx_id_list": """
        SELECT CASE row_idx % 11 WHEN 0 THEN '# ' || pmid WHEN 1 THEN '' ELSE '  ' || pmid END AS line FROM fx_manifest""",
    "fx_nodes": """
        SELECT * FROM (VALUES ('cn23', 'P100'), ('cn30', 'K80'), ('cn41', 'K80')) AS v(node_prefix, gpu_type)""",
}


def _needed(sql: str) -> list[str]:
    """Views that `sql` uses, those they build on first."""
    out: list[str] = []
    for name in re.findall(r"\bfx_\w+", sql):
        for view in [*_needed(VIEWS[name]), name]:
            if view not in out:
                out.append(view)
    return out


def with_views(sql: str) -> str:
    """DuckDB text: the views in front of `sql` as common table expressions."""
    tables = {t: t for t in TABLES}
    ctes = [f"{name} AS ({VIEWS[name].format(**tables)})" for name in _needed(sql)]
    sql = sql.strip()
    if not ctes:
        return sql
    recursive = "RECURSIVE " if sql.startswith("WITH RECURSIVE ") else ""
    sql = sql.replace("WITH RECURSIVE ", "WITH ", 1) if recursive else sql
    head = f"WITH {recursive}" + ",\n".join(ctes)
    return f"{head},\n{sql[5:]}" if sql.upper().startswith("WITH ") else f"{head}\n{sql}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view as a DataFrame."""
    ctes = [f"{v} AS ({VIEWS[v]})" for v in _needed(VIEWS[name])]
    sql = (f"WITH {', '.join(ctes)} " if ctes else "") + VIEWS[name]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql})


@lru_cache(maxsize=None)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; its file footer is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
