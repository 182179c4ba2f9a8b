"""SQL for DuckDB, one text per registered query, over the fixture views."""

from __future__ import annotations

from workload.views import AS_OF

_CLEAN = """clean AS (
    SELECT nullif(trim(pmid, ' ' || chr(9)), '') AS pmid, pdf_path, trim(status) AS status,
           nullif(trim(json_path), '') AS json_path, nullif(trim(md_path), '') AS md_path,
           try_cast(processing_time AS DOUBLE) AS processing_time, nullif(trim(error_msg), '') AS error_msg,
           chunk_file, row_idx
    FROM fx_raw_attempts WHERE trim(pmid, ' ' || chr(9)) <> ''),
last AS (SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY chunk_file DESC, row_idx DESC) = 1)"""

_SHOWN = """pmid, pdf_path, json_path, md_path, status, error_msg, CAST(CAST(processing_time AS FLOAT) AS DOUBLE) AS processing_time,
       coalesce(file_size, -1) AS file_size"""
_TOUCHED = f"updated_at = TIMESTAMP '{AS_OF}' AS touched"

_FOUND = r"""found AS (
    SELECT regexp_extract(regexp_extract(path, '[^/]+$'), '(?i)(\d{6,10})\.pdf$', 1) AS pmid, path AS pdf_path, length AS file_size
    FROM fx_listing WHERE regexp_matches(path, '(?i)\d{6}\.pdf$'))"""

_OUTPUTS = r"""outputs AS (
    SELECT j.pmid, j.json_path, m.path AS md_path
    FROM (SELECT CASE WHEN regexp_matches(path, '/(auto|hybrid_auto|vlm)/') THEN regexp_extract(path, '([^/]+)/(auto|hybrid_auto|vlm)/[^/]*$', 1)
                      ELSE replace(regexp_extract(path, '([^/]+)\.json$', 1), '_content_list', '') END AS pmid, path AS json_path
          FROM fx_files WHERE right(path, 18) = '_content_list.json') j
    LEFT JOIN (SELECT regexp_replace(path, '/[^/]*$', '') AS folder, min(path) AS path FROM fx_files WHERE right(path, 3) = '.md' GROUP BY 1) m
    ON m.folder = regexp_replace(j.json_path, '/[^/]*$', '')
    WHERE j.pmid <> '')"""

_PARSED = r"""landmarks AS (
    SELECT path, regexp_extract(path, '^(.*/)?([^/]+)/(auto|hybrid_auto|vlm)/(.+)$', ['above', 'pmid', 'subdir', 'file']) AS m FROM fx_files),
parsed AS (
    SELECT path, nullif(m.pmid, '') AS pmid, nullif(m.subdir, '') AS subdir, substr(nullif(m.pmid, ''), 1, 3) AS prefix,
           CASE WHEN m.pmid = '' THEN regexp_extract(path, '[^/]+$') ELSE m.file END AS file, '/' || m.above AS above FROM landmarks),
placed AS (
    SELECT *, CASE WHEN pmid IS NULL THEN 'unknown' WHEN ends_with(above, '/' || prefix || '/' || pmid || '/') THEN 'nested'
                   WHEN ends_with(above, '/' || prefix || '/') THEN 'canonical'
                   WHEN ends_with(above, '/' || pmid || '/') THEN 'flat_nested' ELSE 'flat' END AS layout FROM parsed),
files AS (
    SELECT path, CASE WHEN pmid IS NOT NULL THEN 'out' END AS root, prefix, pmid, layout, subdir, file,
           'out/' || prefix || '/' || pmid || '/' || subdir || '/' || file AS dest
    FROM placed)"""

_EXISTING = r"""existing AS (
    SELECT DISTINCT pmid FROM files WHERE layout <> 'flat_nested' AND subdir IN ('auto', 'hybrid_auto')
    AND right(file, 18) = '_content_list.json' AND file NOT LIKE '%/%')"""

_PLAN = r"""plan AS (
    SELECT f.path, f.pmid, f.layout, f.dest,
           CASE WHEN f.layout IN ('flat', 'flat_nested')
                THEN EXISTS (SELECT 1 FROM files h WHERE h.pmid = f.pmid AND h.layout IN ('canonical', 'nested'))
                     OR f.layout = 'flat_nested' AND EXISTS (
                        SELECT 1 FROM files h WHERE h.pmid = f.pmid AND h.layout = 'flat' AND h.subdir = f.subdir)
                WHEN f.layout = 'nested'
                THEN EXISTS (SELECT 1 FROM files h WHERE h.pmid = f.pmid AND h.layout = 'canonical' AND h.subdir = f.subdir)
                ELSE FALSE END AS taken
    FROM files f)"""

_PAIRS = """flags AS (
    SELECT coalesce(a.pmid, o.pmid) AS pmid, a.pmid IS NOT NULL AS recorded, o.pmid IS NOT NULL AS has_output
    FROM (SELECT DISTINCT pmid FROM fx_attempts WHERE status = 'completed') a
    FULL OUTER JOIN fx_outputs o ON a.pmid = o.pmid)"""

# Token by token: `o` is written so far, `deep` the braces within a text macro, `k` the kind of the last token, `w` white space since.
_LATEX = r"""pieces AS (
    SELECT pmid, backend, run, unnest(l) AS p, generate_subscripts(l, 1) AS i
    FROM (SELECT pmid, backend, run, regexp_extract_all(text, '(?s)\$\$(?:[^\\$]|\\.|\$(?:[^\\$]|\\.))*\$\$|\$(?:[^\\$]|\\.)+\$|\\\((?:[^\\]|\\[^()])*\\\)|\\\[(?:[^\\]|\\[^\[\]])*\\\]|\\.|[^\\$]+|.') AS l
          FROM fx_runs) t),
edges AS (
    SELECT *, CASE WHEN length(p) >= 4 AND left(p, 2) IN ('$$', '\(', '\[') THEN 2 WHEN length(p) >= 3 AND left(p, 1) = '$' THEN 1 ELSE 0 END AS e FROM pieces),
tokens AS (
    SELECT pmid, backend, run, i, p, e,
           list_transform(regexp_extract_all(substr(p, e + 1, length(p) - 2 * e), '(?s)\\[A-Za-z]+\*?|\\.|[{}]|[ \t-\r]+|[^\\{} \t-\r]+|.'), lambda x: {
               'o': x, 'deep': 0, 'w': regexp_matches(x, '^[ \t-\r]'),
               'k': CASE WHEN x IN ('\mathbb', '\mathbf', '\mathtt', '\mathrm') THEN 'font'
                         WHEN x IN ('\text', '\textrm', '\textbf', '\textit', '\texttt', '\mbox', '\hbox') THEN 'text'
                         WHEN regexp_matches(x, '^\\[A-Za-z]') THEN 'macro' ELSE '' END}) AS ts
    FROM edges WHERE e > 0),
folded AS (
    SELECT pmid, backend, run, i, left(p, e) || list_reduce(ts, lambda a, x:
        CASE WHEN a.deep > 0 THEN {'o': a.o || x.o, 'deep': a.deep + CASE x.o WHEN '{' THEN 1 WHEN '}' THEN -1 ELSE 0 END, 'w': false, 'k': ''}
             WHEN x.w THEN {'o': a.o, 'deep': 0, 'w': true, 'k': a.k}
             ELSE {'o': a.o || CASE WHEN x.k = 'font' THEN '\mathrm'
                                    WHEN a.k = 'font' AND regexp_matches(x.o, '^[A-Za-z0-9]') THEN '{' || left(x.o, 1) || '}' || substr(x.o, 2)
                                    WHEN a.k IN ('macro', 'text') AND a.w AND regexp_matches(x.o, '^[A-Za-z]') THEN ' ' || x.o ELSE x.o END,
                   'deep': CASE WHEN x.o = '{' AND a.k = 'text' THEN 1 ELSE 0 END, 'w': false, 'k': x.k} END,
        {'o': '', 'deep': 0, 'w': false, 'k': ''}).o || right(p, e) AS f
    FROM tokens),
canon AS (
    SELECT r.pmid, r.backend, r.run, r.text, coalesce(c.folded, r.text) AS folded
    FROM fx_runs r LEFT JOIN (
        SELECT p.pmid, p.backend, p.run, string_agg(coalesce(f.f, p.p), '' ORDER BY p.i) AS folded
        FROM pieces p LEFT JOIN folded f ON f.pmid = p.pmid AND f.run = p.run AND f.i = p.i GROUP BY p.pmid, p.backend, p.run
    ) c ON c.pmid = r.pmid AND c.run = r.run)"""

# The table of scores row by row, each a list; the numbers of each kind are read off the last score.
_ALIGNED = """sequences AS (
    SELECT pmid, backend, run, list({'h': type || chr(31) || text, 'x': x, 'height': height} ORDER BY seq) AS l
    FROM fx_element_runs GROUP BY pmid, backend, run),
pairs AS (
    SELECT *, CAST(least(len(a), len(b)) + 1 AS BIGINT) AS unit
    FROM (SELECT pmid, backend, run AS run_a, lead(run) OVER runs AS run_b, l AS a, lead(l) OVER runs AS b
          FROM sequences WINDOW runs AS (PARTITION BY pmid, backend ORDER BY run)) p
    WHERE run_b IS NOT NULL),
steps AS (
    SELECT pmid, backend, run_a, run_b, a, b, unit, 0 AS i, list_transform(range(len(b) + 1), lambda j: CAST(0 AS BIGINT)) AS score FROM pairs
    UNION ALL
    SELECT pmid, backend, run_a, run_b, a, b, unit, i + 1, [CAST(0 AS BIGINT)] || list_transform(range(1, len(b) + 1), lambda j: list_max(best[1:j]))
    FROM (SELECT *, list_transform(range(1, len(b) + 1), lambda j: greatest(score[j + 1], score[j] +
                 CASE WHEN a[i + 1].h IS DISTINCT FROM b[j].h THEN 1
                      WHEN (a[i + 1].height IS NULL AND b[j].height IS NULL)
                        OR (abs(a[i + 1].x - b[j].x) <= 1.0 AND abs(a[i + 1].height - b[j].height) <= 1.0) THEN unit * unit + unit
                      ELSE unit * unit END)) AS best
          FROM steps WHERE i < len(a)) s),
scored AS (
    SELECT pmid, backend, run_a, run_b, len(a) AS n_a, len(b) AS n_b, score[len(b) + 1] // (unit * unit) AS same,
           score[len(b) + 1] // unit % unit AS kept, score[len(b) + 1] % unit AS changed
    FROM steps WHERE i = len(a))"""

_CHUNKS = """numbered AS (SELECT pmid, row_idx, CAST(floor(row_idx / {size}) AS BIGINT) AS chunk_no FROM {rows})
SELECT chunk_no, 'chunk_' || lpad(CAST(chunk_no AS VARCHAR), 5, '0') AS chunk_id, chunk_no * {size} AS start_index,
       count(*) AS n_docs, arg_min(pmid, row_idx) AS first_id, arg_max(pmid, row_idx) AS last_id
FROM numbered {where} GROUP BY chunk_no"""

_MANIFEST = r"""typed AS (
    SELECT nullif(trim(pmid, ' ' || chr(9)), '') AS pmid, nullif(trim(pdf_path), '') AS pdf_path, row_idx FROM fx_raw_manifest),
lenient AS (
    SELECT coalesce(pmid, regexp_extract(pdf_path, '([^/]+)\.pdf$', 1)) AS pmid, pdf_path, row_idx
    FROM typed WHERE pdf_path IS NOT NULL)"""

# Tag by tag: every piece of markup or text is a row, and running counts tell its block and whether it is in a menu.
_PAGE = r"""bare AS (
    SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<(script|style|head)\b.*?</(script|style|head)\s*>|<div class="ad">.*?</div\s*>', ' ', 'g') AS b FROM pages),
pieces AS (
    SELECT page_id, unnest(l) AS x, generate_subscripts(l, 1) AS i
    FROM (SELECT page_id, regexp_extract_all(b, '(?s)</?[a-zA-Z][^>]*>|<![^>]*>|[^<]+|<') AS l FROM bare) t),
tagged AS (
    SELECT page_id, i, x, lower(regexp_extract(x, '^<(/?[a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM pieces),
kinds AS (
    SELECT *, ltrim(tag, '/') IN ('address', 'article', 'aside', 'blockquote', 'body', 'caption', 'dd', 'details', 'div', 'dl', 'dt',
        'fieldset', 'figcaption', 'figure', 'footer', 'form', 'h1', 'h2', 'h3', 'h4', 'h5', 'h6', 'header', 'hr', 'html', 'li', 'main', 'nav',
        'ol', 'p', 'pre', 'section', 'summary', 'table', 'tbody', 'td', 'tfoot', 'th', 'thead', 'title', 'tr', 'ul') AS is_block
    FROM tagged),
placed AS (
    SELECT *, sum(CASE WHEN is_block THEN 1 ELSE 0 END) OVER run AS block,
           sum(CASE tag WHEN 'nav' THEN 1 WHEN '/nav' THEN -1 ELSE 0 END) OVER run > 0 AS nav
    FROM kinds WINDOW run AS (PARTITION BY page_id ORDER BY i)),
joined AS (
    SELECT page_id, block, coalesce(max(tag) FILTER (WHERE is_block), '') AS tag, bool_or(nav) AS nav,
           coalesce(string_agg(CASE WHEN tag = 'br' THEN chr(10) WHEN tag = '' AND NOT starts_with(x, '<!') THEN x END, '' ORDER BY i), '') AS raw
    FROM placed GROUP BY page_id, block),
plain AS (
    SELECT *, trim(replace(replace(replace(replace(replace(replace(replace(replace(raw, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''),
                  '&nbsp;', chr(160)), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&'), ' ' || chr(9) || chr(10) || chr(13) || chr(160)) AS text FROM joined),
elements AS (
    SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY block) - 1 AS seq, nav,
           CASE WHEN nav THEN 'discarded' WHEN tag = 'li' THEN 'list' WHEN tag = 'footer' THEN 'footer' ELSE 'text' END AS type, text
    FROM plain WHERE text <> '')"""

_LINES = """lines AS (
    SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS seq
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) t),
kept AS (
    SELECT doc_id, CAST(seq AS BIGINT) AS seq, trim(line, ' ' || chr(9) || chr(13) || chr(160)) AS text
    FROM lines WHERE trim(line, ' ' || chr(9) || chr(13) || chr(160)) <> '')"""

_BASE = """times AS (
    SELECT gpu_type, avg(seconds) FILTER (WHERE backend = 'pipeline') AS pipeline,
           avg(seconds) FILTER (WHERE backend = 'hybrid') AS hybrid, avg(seconds) FILTER (WHERE backend = 'vlm') AS vlm,
           avg(seconds) FILTER (WHERE backend IS NULL OR backend NOT IN ('pipeline', 'hybrid', 'vlm')) AS other
    FROM fx_timings GROUP BY gpu_type)"""

_PCT = "CASE WHEN {total} > 0 THEN round(100.0 * {part} / {total}, 1) ELSE 0.0 END"

_DOC = """docs AS (
    SELECT pmid, backend, count(*) AS n_elements, CAST(sum(length(text)) AS BIGINT) AS n_chars,
           CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) + count(*) - 1 AS BIGINT) AS md_lines,
           CAST(sum(strlen(CAST(to_json({'type': type, 'text': text, 'page_idx': page_idx}) AS VARCHAR))) + count(*) + 1 AS BIGINT) AS json_bytes
    FROM fx_elements GROUP BY pmid, backend)"""

_APPLIED = f"""WITH {_CLEAN},
    applied AS (SELECT r.pmid, r.pdf_path, CASE WHEN l.pmid IS NULL THEN r.json_path ELSE l.json_path END AS json_path,
                CASE WHEN l.pmid IS NULL THEN r.md_path ELSE l.md_path END AS md_path,
                CASE WHEN l.pmid IS NULL THEN r.status ELSE l.status END AS status,
                CASE WHEN l.pmid IS NULL THEN r.error_msg ELSE l.error_msg END AS error_msg,
                CASE WHEN l.pmid IS NULL THEN r.processing_time ELSE l.processing_time END AS processing_time,
                r.file_size, l.pmid IS NOT NULL AS touched
         FROM fx_registry r LEFT JOIN last l ON l.pmid = r.pmid)"""

ORACLE = {
    "ledger_status": f"""WITH {_CLEAN},
        state AS (SELECT coalesce(l.status, 'pending') AS status FROM fx_manifest m LEFT JOIN last l ON l.pmid = m.pmid)
        SELECT status, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM state GROUP BY status""",
    "status_counts": """
        SELECT status, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM fx_registry), 1) AS pct
        FROM fx_registry GROUP BY status
        UNION ALL SELECT 'Total', count(*), 100.0 FROM fx_registry""",
    "avg_time_completed": """
        SELECT round(avg(CAST(processing_time AS DOUBLE)), 6) AS avg_time, count(processing_time) AS n_timed
        FROM fx_registry WHERE status = 'completed'""",
    "recent_failures": """
        SELECT pmid, coalesce(substr(nullif(error_msg, ''), 1, 60), 'Unknown error') AS message
        FROM fx_registry WHERE status = 'failed' ORDER BY updated_at DESC, pmid LIMIT 5""",
    "export_pending": "SELECT pmid, pdf_path FROM fx_registry WHERE status = 'pending'",
    "export_failed": "SELECT pmid, pdf_path FROM fx_registry WHERE status = 'failed'",
    "export_by_size": """
        SELECT pmid, pdf_path FROM fx_registry
        WHERE status IN ('pending', 'failed') AND file_size BETWEEN 1048576 AND 5242880""",
    "export_by_size_exclusive": """
        SELECT pmid, pdf_path FROM fx_registry WHERE status IN ('pending', 'failed') AND file_size < 5242880""",
    "size_histogram": """
        SELECT CASE WHEN file_size < 1048576 THEN '<1MB' WHEN file_size < 5242880 THEN '1-5MB'
                    WHEN file_size < 10485760 THEN '5-10MB' ELSE '>10MB' END AS size_band, count(*) AS n
        FROM fx_registry WHERE file_size IS NOT NULL GROUP BY 1""",
    "insert_if_absent": f"""WITH {_FOUND},
        added AS (SELECT pmid, pdf_path, file_size FROM found WHERE pmid NOT IN (SELECT pmid FROM fx_registry)
                  QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY pdf_path) = 1)
        SELECT {_SHOWN}, {_TOUCHED} FROM fx_registry
        UNION ALL SELECT pmid, pdf_path, NULL, NULL, 'pending', NULL, NULL, coalesce(file_size, -1), TRUE FROM added""",
    "insert_manifest": f"""WITH {_MANIFEST},
        base AS (SELECT * FROM fx_registry WHERE status <> 'pending'),
        added AS (SELECT pmid, pdf_path FROM lenient WHERE pmid NOT IN (SELECT pmid FROM base)
                  QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY row_idx) = 1)
        SELECT {_SHOWN}, {_TOUCHED} FROM base
        UNION ALL SELECT pmid, pdf_path, NULL, NULL, 'pending', NULL, NULL, -1, TRUE FROM added""",
    "ingest_counts": f"""WITH {_FOUND}, ids AS (SELECT DISTINCT pmid FROM found)
        SELECT (SELECT count(*) FROM fx_registry) AS existing,
               (SELECT count(*) FROM ids WHERE pmid NOT IN (SELECT pmid FROM fx_registry)) AS added,
               (SELECT count(*) FROM ids WHERE pmid IN (SELECT pmid FROM fx_registry)) AS already_known,
               (SELECT count(*) FROM (SELECT pmid FROM fx_registry UNION SELECT pmid FROM ids) u) AS total""",
    "apply_results": f"{_APPLIED} SELECT {_SHOWN}, touched FROM applied",
    "ingest_attempt_stream": f"{_APPLIED} SELECT {_SHOWN} FROM applied",
    "complete_from_outputs": f"""WITH {_OUTPUTS},
        first AS (SELECT * FROM outputs QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY json_path) = 1),
        applied AS (SELECT r.pmid, r.pdf_path, CASE WHEN hit THEN f_json ELSE json_path END AS json_path,
                           CASE WHEN hit THEN f_md ELSE md_path END AS md_path,
                           CASE WHEN hit THEN 'completed' ELSE status END AS status, error_msg, processing_time, file_size,
                           coalesce(hit, FALSE) AS touched
                    FROM (SELECT r0.*, f.json_path AS f_json, f.md_path AS f_md, f.pmid IS NOT NULL AND r0.status <> 'completed' AS hit
                          FROM fx_registry r0 LEFT JOIN first f ON f.pmid = r0.pmid) r)
        SELECT {_SHOWN}, touched FROM applied""",
    "demote_missing": f"""
        WITH applied AS (SELECT r.pmid, r.pdf_path, json_path, md_path, CASE WHEN hit THEN 'failed' ELSE status END AS status,
                                CASE WHEN hit THEN 'No output files generated' ELSE error_msg END AS error_msg,
                                processing_time, file_size, hit AS touched
                         FROM (SELECT *, status IS NOT NULL AND status = 'completed' AND pmid NOT IN (SELECT pmid FROM fx_outputs) AS hit
                               FROM fx_registry) r)
        SELECT {_SHOWN}, touched FROM applied""",
    "retry_failed": f"""
        WITH applied AS (SELECT pmid, pdf_path, json_path, md_path, CASE WHEN status = 'failed' THEN 'pending' ELSE status END AS status,
                                CASE WHEN status = 'failed' THEN NULL ELSE error_msg END AS error_msg,
                                CASE WHEN status = 'failed' THEN NULL ELSE processing_time END AS processing_time,
                                file_size, coalesce(status = 'failed', FALSE) AS touched FROM fx_registry)
        SELECT {_SHOWN}, touched FROM applied""",
    "registry_snapshot": f"""
        WITH applied AS (SELECT pmid, pdf_path, json_path, md_path, CASE WHEN status = 'failed' THEN 'pending' ELSE status END AS status,
                                CASE WHEN status = 'failed' THEN NULL ELSE error_msg END AS error_msg,
                                CASE WHEN status = 'failed' THEN NULL ELSE processing_time END AS processing_time,
                                file_size, coalesce(status = 'failed', FALSE) AS touched FROM fx_registry)
        SELECT {_SHOWN}, touched FROM applied""",
    "size_backfill": f"""
        WITH filled AS (SELECT r.* REPLACE (coalesce(r.file_size, l.length) AS file_size)
                        FROM fx_registry r LEFT JOIN fx_listing l ON l.path = r.pdf_path)
        SELECT {_SHOWN}, {_TOUCHED} FROM filled""",
    "size_backfill_counts": """
        SELECT count(*) AS unknown, count(l.path) AS updated, count(*) FILTER (WHERE l.path IS NULL) AS missing
        FROM fx_registry r LEFT JOIN fx_listing l ON l.path = r.pdf_path WHERE r.file_size IS NULL""",
    "duplicate_ids": "SELECT pmid, count(*) AS n FROM fx_attempts GROUP BY pmid HAVING count(*) > 1",
    "results_clean": f"""WITH {_CLEAN}
        SELECT pmid, status, json_path, md_path, error_msg, processing_time, row_idx FROM clean""",
    "attempt_times": """
        SELECT row_idx, CASE WHEN row_idx % 17 <> 3 THEN date_trunc('second', processed_at) END AS processed_at FROM fx_raw_attempts""",
    "merged_results": f"WITH {_CLEAN} SELECT pmid, status, error_msg, processing_time FROM last",
    "attempts_mixed_headers": """
        SELECT pmid, status, count(*) AS n, count(CASE WHEN row_idx % 3 = 1 THEN processing_time END) AS timed FROM fx_attempts GROUP BY pmid, status""",
    "strict_insert": f"""WITH {_MANIFEST}
        SELECT pmid, pdf_path, status FROM fx_registry WHERE status <> 'pending'
        UNION ALL SELECT pmid, pdf_path, 'pending' FROM typed
        WHERE pmid IS NOT NULL AND pdf_path IS NOT NULL AND pmid NOT IN (SELECT pmid FROM fx_registry WHERE status <> 'pending')
        QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY row_idx) = 1""",
    "merge_keep_last": f"""WITH {_CLEAN}
        SELECT pmid, pdf_path, status, json_path, md_path, processing_time, error_msg, chunk_file, row_idx FROM last""",
    "attempts_scan": f"""WITH {_CLEAN}
        SELECT pmid, pdf_path, status, json_path, md_path, error_msg, processing_time FROM clean""",
    "attempts_merged_from_csv": f"WITH {_CLEAN} SELECT pmid, status, error_msg, processing_time FROM last",
    "attempts_merged_from_parquet": f"WITH {_CLEAN} SELECT pmid, status, error_msg, processing_time FROM last",
    "attempt_log": """
        SELECT CASE status WHEN 'completed' THEN 'first' ELSE 'second' END AS run_id, status, count(*) AS n
        FROM fx_attempts GROUP BY 1, 2""",
    "merge_summary": f"""
        WITH counts AS (
            SELECT count(*) AS total, count(*) FILTER (WHERE status = 'completed') AS completed,
                   count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'pending') AS pending,
                   round(coalesce(avg(t) FILTER (WHERE t > 0 AND NOT isnan(t)), 0), 6) AS avg_time,
                   count(DISTINCT nullif(trim(pmid), '')) AS unique_ids
            FROM (SELECT *, try_cast(processing_time AS DOUBLE) AS t FROM fx_raw_attempts) a)
        SELECT *, {_PCT.format(part='completed', total='total')} AS completed_pct,
               {_PCT.format(part='failed', total='total')} AS failed_pct,
               {_PCT.format(part='pending', total='total')} AS pending_pct FROM counts""",
    "run_summary": f"""WITH {_PARSED}, {_EXISTING}
        SELECT count(*) FILTER (WHERE status = 'completed') AS completed, count(*) FILTER (WHERE status <> 'completed') AS failed,
               (SELECT count(*) FROM fx_manifest WHERE pmid IN (SELECT pmid FROM existing)) AS skipped,
               count(*) FILTER (WHERE status <> 'completed') = 0 AS ok
        FROM fx_attempts""",
    "suspect_fast": """
        SELECT pmid, processing_time, chunk_file, row_idx FROM fx_attempts WHERE status = 'completed' AND processing_time < 50""",
    "manifest_strict": f"WITH {_MANIFEST} SELECT pmid, pdf_path FROM typed WHERE pmid IS NOT NULL AND pdf_path IS NOT NULL",
    "manifest_lenient": f"WITH {_MANIFEST} SELECT pmid, pdf_path FROM lenient",
    "manifest_slice": f"""WITH {_MANIFEST}
        SELECT pmid, pdf_path, row_idx FROM lenient WHERE row_idx >= 20 ORDER BY row_idx LIMIT 100""",
    "manifest_export": "SELECT pmid, pdf_path FROM fx_registry WHERE status = 'pending'",
    "id_list": "SELECT trim(line) AS pmid FROM fx_id_list WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#')",
    "chunk_assignment": """
        WITH numbered AS (SELECT pmid, row_number() OVER (ORDER BY pmid) - 1 AS row_idx FROM fx_manifest)
        SELECT pmid, row_idx, CAST(floor(row_idx / 40) AS BIGINT) AS chunk_no,
               'chunk_' || lpad(CAST(CAST(floor(row_idx / 40) AS BIGINT) AS VARCHAR), 5, '0') AS chunk_id,
               CAST(floor(row_idx / 40) AS BIGINT) * 40 AS start_index
        FROM numbered""",
    "chunk_plan": "WITH " + _CHUNKS.format(size=100, rows="fx_manifest", where=""),
    "trial_chunks": "WITH " + _CHUNKS.format(size=100, rows="fx_manifest", where="WHERE chunk_no < 5"),
    "cleanup_chunks": "WITH ids AS (SELECT pmid, row_number() OVER (ORDER BY pmid) - 1 AS row_idx "
        "FROM (SELECT DISTINCT pmid FROM fx_files) d), " + _CHUNKS.format(size=500, rows="ids", where=""),
    "scan_ids": f"WITH {_FOUND} SELECT pmid, pdf_path, file_size FROM found",
    "stem_ids": r"SELECT regexp_extract(path, '([^/]+)\.[^./]+$', 1) AS pmid, path AS pdf_path FROM fx_listing",
    "scan_outputs": f"WITH {_OUTPUTS} SELECT pmid, json_path, md_path FROM outputs",
    "output_paths": f"WITH {_PARSED} SELECT path, root, prefix, pmid, layout, subdir, file, dest FROM files",
    "layout_plan": f"""WITH {_PARSED}, {_PLAN}
        SELECT path, pmid, layout, dest,
               CASE WHEN layout IN ('canonical', 'unknown') THEN 'NONE' WHEN taken THEN 'SKIP' WHEN layout = 'nested' THEN 'FLATTEN' ELSE 'MOVE' END AS action,
               CASE WHEN layout NOT IN ('canonical', 'unknown') AND taken THEN 'destination exists' END AS reason
        FROM plan""",
    "layout_plan_for_ids": f"""WITH {_PARSED}, {_PLAN}, ids AS (SELECT pmid FROM fx_manifest)
        SELECT path, pmid, layout, dest,
               CASE WHEN layout <> 'nested' THEN 'NONE' WHEN taken THEN 'SKIP' ELSE 'FLATTEN' END AS action,
               CASE WHEN layout = 'nested' AND taken THEN 'destination exists' END AS reason
        FROM plan WHERE pmid IN (SELECT pmid FROM ids)
        UNION ALL SELECT NULL, pmid, NULL, NULL, 'SKIP', CASE
            WHEN pmid IN (SELECT pmid FROM files WHERE layout IN ('canonical', 'nested')) THEN 'nothing nested' ELSE 'destination does not exist' END
        FROM ids WHERE pmid NOT IN (SELECT pmid FROM files WHERE layout = 'nested')""",
    "pending_work": f"""WITH {_PARSED}, {_EXISTING}
        SELECT pmid, pdf_path FROM fx_manifest WHERE pmid NOT IN (SELECT pmid FROM existing)""",
    "missing_inputs": """
        SELECT pmid, pdf_path, 'failed' AS status, 'PDF file not found: ' || pdf_path AS error_msg
        FROM fx_manifest WHERE pdf_path NOT IN (SELECT path FROM fx_listing)""",
    "scalar_functions": r"""
        SELECT row_idx, nullif(trim(pmid), '') AS pmid, substr(trim(pmid), 1, 3) AS prefix,
               regexp_extract(pdf_path, '([^/]+)\.pdf$', 1) AS stem, regexp_extract(json_path, '([^/]+)\.json$', 1) AS json_stem,
               try_cast(processing_time AS DOUBLE) AS seconds,
               CASE WHEN try_cast(processing_time AS DOUBLE) IS NULL THEN NULL
                    WHEN isnan(try_cast(processing_time AS DOUBLE)) THEN '<1MB'
                    WHEN floor(try_cast(processing_time AS DOUBLE) * 100000) < 1048576 THEN '<1MB'
                    WHEN floor(try_cast(processing_time AS DOUBLE) * 100000) < 5242880 THEN '1-5MB'
                    WHEN floor(try_cast(processing_time AS DOUBLE) * 100000) < 10485760 THEN '5-10MB' ELSE '>10MB' END AS band
        FROM fx_raw_attempts""",
    "latex_canonical": f"WITH {_LATEX} SELECT pmid, run, folded AS text FROM canon",
    "completion_audit": f"""WITH {_PAIRS},
        counts AS (SELECT count(*) FILTER (WHERE recorded) AS completed, count(*) FILTER (WHERE has_output) AS with_output,
                          count(*) FILTER (WHERE recorded AND has_output) AS overlap,
                          count(*) FILTER (WHERE recorded AND NOT has_output) AS missing,
                          count(*) FILTER (WHERE has_output AND NOT recorded) AS unrecorded FROM flags)
        SELECT *, {_PCT.format(part='missing', total='completed')} AS missing_pct FROM counts""",
    "missing_outputs": """
        SELECT pmid FROM fx_attempts WHERE status = 'completed' EXCEPT SELECT pmid FROM fx_outputs""",
    "overlapping_outputs": """
        SELECT pmid FROM fx_attempts WHERE status = 'completed' INTERSECT SELECT pmid FROM fx_outputs""",
    "unrecorded_outputs": """
        SELECT pmid FROM fx_outputs EXCEPT SELECT pmid FROM fx_attempts WHERE status = 'completed'""",
    "failure_by_node": """
        WITH per_id AS (SELECT node_prefix, pmid, sum(processing_time) AS s, count(processing_time) AS t,
                               pmid IN (SELECT pmid FROM fx_outputs) AS has_output
                        FROM fx_attempts WHERE status = 'completed' GROUP BY node_prefix, pmid),
             stats AS (SELECT node_prefix, count(*) AS completed, count(*) FILTER (WHERE has_output) AS with_output,
                              count(*) FILTER (WHERE NOT has_output) AS silent_failures, sum(s) / sum(t) AS avg_time
                       FROM per_id GROUP BY node_prefix),
             chunks AS (SELECT node_prefix, count(DISTINCT chunk_file) AS chunks FROM fx_attempts GROUP BY node_prefix)
        SELECT c.node_prefix, n.gpu_type, c.chunks, coalesce(completed, 0) AS completed, coalesce(with_output, 0) AS with_output,
               coalesce(silent_failures, 0) AS silent_failures, round(100.0 * silent_failures / completed, 1) AS fail_pct,
               round(avg_time, 6) AS avg_time
        FROM chunks c LEFT JOIN stats s ON s.node_prefix IS NOT DISTINCT FROM c.node_prefix LEFT JOIN fx_nodes n ON n.node_prefix = c.node_prefix""",
    "time_by_outcome": """
        WITH timed AS (SELECT CASE WHEN status = 'failed' THEN 'failed'
                                   WHEN pmid IN (SELECT pmid FROM fx_outputs) THEN 'success' ELSE 'silent' END AS outcome, processing_time
                       FROM fx_attempts WHERE status IN ('completed', 'failed') AND processing_time IS NOT NULL),
             ranked AS (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY processing_time) AS rank,
                               count(*) OVER (PARTITION BY outcome) AS n FROM timed)
        SELECT outcome, count(*) AS attempts, min(processing_time) AS min_time,
               min(processing_time) FILTER (WHERE rank = ceil(0.5 * n)) AS median_time, max(processing_time) AS max_time
        FROM ranked GROUP BY outcome""",
    "gpu_backend_pivot": f"""WITH {_BASE}
        SELECT gpu_type, round(pipeline, 6) AS pipeline, round(hybrid, 6) AS hybrid, round(vlm, 6) AS vlm, round(other, 6) AS other FROM times""",
    "attempt_timings": """
        WITH timed AS (SELECT n.gpu_type, a.backend, a.processing_time AS t FROM fx_attempts a LEFT JOIN fx_nodes n USING (node_prefix)
                       WHERE a.status = 'completed')
        SELECT gpu_type, round(avg(t) FILTER (WHERE backend = 'pipeline'), 6) AS pipeline,
               round(avg(t) FILTER (WHERE backend = 'hybrid-auto-engine'), 6) AS hybrid,
               round(avg(t) FILTER (WHERE backend = 'vlm-auto-engine'), 6) AS vlm,
               round(avg(t) FILTER (WHERE backend IS NULL OR backend NOT IN ('pipeline', 'hybrid-auto-engine', 'vlm-auto-engine')), 6) AS other
        FROM timed GROUP BY gpu_type""",
    "relative_speed": f"""WITH {_BASE}
        SELECT gpu_type, round(pipeline / pipeline, 1) AS pipeline, round(hybrid / pipeline, 1) AS hybrid,
               round(vlm / pipeline, 1) AS vlm, round(other / pipeline, 1) AS other FROM times""",
    "element_types": """
        SELECT type, count(*) FILTER (WHERE backend = 'pipeline') AS pipeline, count(*) FILTER (WHERE backend = 'hybrid-auto-engine') AS hybrid,
               count(*) FILTER (WHERE backend = 'vlm') AS vlm,
               count(*) FILTER (WHERE backend IS NULL OR backend NOT IN ('pipeline', 'hybrid-auto-engine', 'vlm')) AS other
        FROM fx_elements GROUP BY type""",
    "doc_structure": f"WITH {_DOC} SELECT pmid, backend, n_elements, n_chars, md_lines, json_bytes FROM docs",
    "backend_structure": f"""WITH {_DOC}
        SELECT backend, count(*) AS n_docs, round(avg(n_elements), 6) AS avg_elements, round(avg(n_chars), 6) AS avg_chars,
               round(avg(md_lines), 6) AS avg_md_lines, round(avg(json_bytes), 6) AS avg_json_bytes FROM docs GROUP BY backend""",
    "content_digests": """
        WITH hashed AS (SELECT pmid, backend, md5(concat_ws(chr(31), CAST(seq AS VARCHAR), type, text)) AS h FROM fx_elements)
        SELECT pmid, backend, concat_ws('-', CAST(count(*) AS VARCHAR),
               CAST(bit_xor(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS VARCHAR),
               CAST(bit_xor(CAST('0x' || substr(h, 16, 15) AS BIGINT)) AS VARCHAR)) AS digest
        FROM hashed GROUP BY pmid, backend""",
    "run_differences": f"""WITH RECURSIVE {_ALIGNED}
        SELECT pmid, backend, run_a, run_b, kept, same - kept AS moved, changed, n_a - same - changed AS removed, n_b - same - changed AS inserted
        FROM scored""",
    "output_consistency": """
        WITH per_digest AS (SELECT pmid, backend, md5(text) AS digest, count(*) AS n FROM fx_runs GROUP BY ALL)
        SELECT pmid, backend, CAST(sum(n) AS BIGINT) AS runs, count(*) AS distinct_digests, max(n) AS largest_group, count(*) = 1 AS consistent
        FROM per_digest GROUP BY pmid, backend""",
    "output_consistency_tolerant": f"""WITH {_LATEX},
        per_doc AS (SELECT pmid, backend, count(*) AS runs, count(DISTINCT md5(folded)) AS d FROM canon GROUP BY pmid, backend)
        SELECT backend, count(*) AS n_docs, count(*) FILTER (WHERE d = 1) AS consistent_docs, CAST(sum(runs) AS BIGINT) AS runs,
               CAST(sum(d) AS BIGINT) AS distinct_digests
        FROM per_doc GROUP BY backend""",
    "agreeing_runs": f"""WITH {_LATEX}
        SELECT pmid, backend, run, md5(folded) AS digest, count(*) OVER (PARTITION BY pmid, backend, md5(folded)) AS same_output
        FROM canon""",
    "throughput_hourly": """
        SELECT strftime(date_trunc('hour', processed_at), '%Y-%m-%d %H:%M') AS hour, count(DISTINCT chunk_file) AS chunks, count(*) AS documents
        FROM fx_attempts GROUP BY 1""",
    "storage_by_artifact": """
        SELECT CASE WHEN right(path, 18) = '_content_list.json' THEN 'content_list' WHEN right(path, 12) = '_middle.json' THEN 'middle'
                    WHEN right(path, 11) = '_model.json' THEN 'model' WHEN right(path, 3) = '.md' THEN 'markdown' ELSE 'other' END AS artifact,
               count(*) AS files, CAST(sum(length) AS BIGINT) AS bytes, count(DISTINCT pmid) AS documents,
               round(sum(length) / count(DISTINCT pmid), 6) AS bytes_per_doc
        FROM fx_files GROUP BY 1""",
    "gpu_utilization": """
        SELECT node, substr(trim(gpu_name), 1, 24) AS gpu_short, count(*) AS n_samples,
               CAST(floor(avg(CAST(trim(utilization) AS BIGINT))) AS BIGINT) AS avg_utilization
        FROM fx_telemetry WHERE regexp_matches(trim(utilization), '^[0-9]+$') GROUP BY 1, 2""",
    "gpu_samples": """
        SELECT node, trim(gpu_name) AS gpu_name, trim(utilization) AS utilization, temperature, power, trim(memory_used) AS memory_used,
               trim(memory_total) AS memory_total, substr(trim(gpu_name), 1, 24) AS gpu_short,
               trim(memory_used) || '/' || trim(memory_total) || 'MB' AS memory
        FROM fx_telemetry""",
    "log_lines": r"""
        SELECT chunk_no, CAST(regexp_extract(line, '^\[(\d+)/(\d+)\] (✓|✗) (\S+) \(([\d.]+)s\)', 1) AS BIGINT) AS n,
               CAST(regexp_extract(line, '^\[(\d+)/(\d+)\] (✓|✗) (\S+) \(([\d.]+)s\)', 2) AS BIGINT) AS total,
               CASE regexp_extract(line, '^\[(\d+)/(\d+)\] (✓|✗) (\S+) \(([\d.]+)s\)', 3) WHEN '✓' THEN 'completed' ELSE 'failed' END AS status,
               regexp_extract(line, '^\[(\d+)/(\d+)\] (✓|✗) (\S+) \(([\d.]+)s\)', 4) AS pmid,
               CAST(regexp_extract(line, '^\[(\d+)/(\d+)\] (✓|✗) (\S+) \(([\d.]+)s\)', 5) AS DOUBLE) AS seconds
        FROM fx_logs WHERE regexp_matches(line, '^\[(\d+)/(\d+)\] (✓|✗) (\S+) \(([\d.]+)s\)')""",
    "log_attempts": r"""
        WITH named AS (SELECT chunk_no, arg_min(substr(regexp_extract(line, 'cn[0-9]+'), 1, 4), line_no) AS node_prefix
                       FROM fx_logs WHERE regexp_matches(line, 'cn[0-9]') GROUP BY chunk_no),
             told AS (SELECT *, CAST(nullif(regexp_extract(line, '^\[(\d+)/\d+\] ', 1), '') AS BIGINT) AS n FROM fx_logs),
             counted AS (SELECT *, lag(n) OVER (PARTITION BY chunk_no ORDER BY line_no) AS before FROM told WHERE n IS NOT NULL),
             runs AS (SELECT chunk_no, line_no, line, n, sum(CASE WHEN n <= before THEN 1 ELSE 0 END) OVER (PARTITION BY chunk_no ORDER BY line_no) AS run,
                             lead(line_no) OVER (PARTITION BY chunk_no ORDER BY line_no) AS next FROM counted),
             details AS (SELECT r.chunk_no, r.line_no, string_agg(t.line, chr(10) ORDER BY t.line_no) AS detail
                         FROM runs r JOIN told t ON t.chunk_no = r.chunk_no AND t.n IS NULL AND t.line_no > r.line_no AND (r.next IS NULL OR t.line_no < r.next)
                         GROUP BY r.chunk_no, r.line_no)
        SELECT regexp_extract(line, '. (\S+) \(([\d.]+)s\)', 1) AS pmid,
               CASE WHEN contains(line, '✓') THEN 'completed' ELSE 'failed' END AS status,
               CAST(regexp_extract(line, '\(([\d.]+)s\)', 1) AS DOUBLE) AS processing_time,
               'chunk_' || lpad(CAST(l.chunk_no AS VARCHAR), 5, '0') AS chunk_file,
               CAST(run AS BIGINT) * 4294967296 + n AS row_idx, CAST(run AS BIGINT) AS run, detail, node_prefix
        FROM runs l LEFT JOIN named m ON m.chunk_no = l.chunk_no LEFT JOIN details d ON d.chunk_no = l.chunk_no AND d.line_no = l.line_no
        WHERE contains(line, '✓') OR contains(line, '✗')""",
    "chunk_nodes": """
        WITH named AS (SELECT chunk_no, line_no, regexp_extract(line, 'cn[0-9]+') AS node FROM fx_logs WHERE regexp_matches(line, 'cn[0-9]'))
        SELECT chunk_no, arg_min(node, line_no) AS node, substr(arg_min(node, line_no), 1, 4) AS node_prefix FROM named GROUP BY chunk_no""",
    "page_elements": f"WITH {_PAGE} SELECT page_id, seq, type, text FROM elements",
    "page_outcomes": f"""WITH {_PAGE}, n AS (SELECT page_id, count(*) AS n FROM elements WHERE NOT nav GROUP BY page_id)
        SELECT p.page_id, CASE WHEN n.n > 0 THEN 'completed' ELSE 'failed' END AS status,
               CASE WHEN n.n IS NULL THEN 'No output files generated' END AS error_msg, coalesce(n.n, 0) AS n_elements
        FROM pages p LEFT JOIN n ON n.page_id = p.page_id""",
    "text_elements": f"WITH {_LINES} SELECT doc_id, seq, 'text' AS type, text FROM kept",
    "content_elements": f"""WITH {_PAGE}
        SELECT page_id, seq, type, text, CAST(0 AS BIGINT) AS page_idx, 'page ' || page_id AS img_caption, CAST(NULL AS VARCHAR) AS error FROM elements
        UNION ALL SELECT page_id, NULL, NULL, NULL, NULL, NULL, 'content list is no JSON array of objects' FROM pages WHERE length(url) % 7 = 0""",
    "extracted_elements": f"""WITH {_LINES}, n AS (SELECT doc_id, count(*) AS n FROM kept GROUP BY doc_id)
        SELECT CAST(d.doc_id AS VARCHAR) AS pmid, CASE WHEN n.n > 0 THEN 'completed' ELSE 'failed' END AS status,
               CASE WHEN n.n IS NULL THEN 'No output files generated' END AS error_msg, 'pipeline' AS backend, coalesce(n.n, 0) AS n_elements
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id""",
    "extracted_text": f"""WITH {_LINES}
        SELECT CAST(doc_id AS VARCHAR) AS pmid, row_number() OVER (PARTITION BY doc_id ORDER BY seq) - 1 AS seq, 'text' AS type, text FROM kept""",
    "processed_manifest": f"""WITH {_PARSED}, {_EXISTING}, {_LINES},
        n AS (SELECT doc_id AS row_idx, count(*) AS n FROM kept GROUP BY doc_id),
        todo AS (SELECT m.pmid, m.pdf_path, coalesce(n.n, 0) AS n, m.pdf_path IN (SELECT path FROM fx_listing) AS listed
                 FROM fx_manifest m LEFT JOIN n ON n.row_idx = m.row_idx WHERE m.pmid NOT IN (SELECT pmid FROM existing))
        SELECT pmid, CASE WHEN listed AND n > 0 THEN 'completed' ELSE 'failed' END AS status,
               CASE WHEN NOT listed THEN 'PDF file not found: ' || pdf_path WHEN n = 0 THEN 'No output files generated' END AS error_msg,
               CASE WHEN listed THEN n ELSE 0 END AS n_elements
        FROM todo""",
    "processed_by_backend": f"""WITH {_PARSED}, {_EXISTING}, {_LINES},
        n AS (SELECT doc_id, count(*) AS n FROM kept GROUP BY doc_id),
        todo AS (SELECT m.pmid, m.pdf_path, m.pdf_path IN (SELECT path FROM fx_listing) AS listed, coalesce(n.n, 0) AS n,
                        CASE WHEN d.lang = 'de' THEN 'nova-engine' WHEN m.file_size < 3000000 THEN 'pipeline' ELSE 'vlm-auto-engine' END AS backend
                 FROM fx_manifest m JOIN documents d ON d.doc_id = m.row_idx LEFT JOIN n ON n.doc_id = m.row_idx
                 WHERE m.pmid NOT IN (SELECT pmid FROM existing)),
        made AS (SELECT *, CASE WHEN NOT listed OR backend = 'nova-engine' THEN 0 WHEN backend = 'pipeline' THEN n ELSE least(n, 1) END AS elements FROM todo)
        SELECT pmid, backend, CASE WHEN elements > 0 THEN 'completed' ELSE 'failed' END AS status,
               CASE WHEN NOT listed THEN 'PDF file not found: ' || pdf_path WHEN backend = 'nova-engine' THEN 'Unknown backend: nova-engine'
                    WHEN elements = 0 THEN 'No output files generated' END AS error_msg, elements AS n_elements
        FROM made""",
    "output_by_prefix": "SELECT substr(pmid, 1, 3) AS prefix, count(*) AS n FROM fx_manifest GROUP BY 1",
    "discovered_pdfs": "SELECT pmid, substr(pmid, 1, 3) || '/' || pmid || '.pdf' AS pdf_path FROM fx_manifest WHERE file_size >= 900000",
    "registry_tsv": "SELECT pmid, status, error_msg, CAST(file_size AS VARCHAR) AS file_size FROM fx_registry",
    "older_registry": """
        SELECT r.pmid, CAST(NULL AS BIGINT) AS size_1, min(l.length) AS size_2
        FROM fx_registry r LEFT JOIN fx_listing l ON l.path = r.pdf_path GROUP BY r.pmid""",
    "time_bands": """
        SELECT CASE WHEN status = 'failed' THEN 'failed' WHEN pmid IN (SELECT pmid FROM fx_outputs) THEN 'success' ELSE 'silent' END AS outcome,
               count(*) AS attempts, min(processing_time) AS min_time, max(processing_time) AS max_time, TRUE AS within
        FROM fx_attempts WHERE status IN ('completed', 'failed') AND processing_time IS NOT NULL GROUP BY 1""",
    "sketched_audit": f"""WITH {_PAIRS}
        SELECT count(*) FILTER (WHERE recorded) AS completed, count(*) FILTER (WHERE has_output) AS with_output,
               count(*) FILTER (WHERE recorded AND has_output) AS overlap, count(*) FILTER (WHERE recorded AND NOT has_output) AS missing,
               count(*) FILTER (WHERE has_output AND NOT recorded) AS unrecorded FROM flags""",
    "registry_query": "SELECT status, count(*) AS n, count(json_path) AS with_json FROM fx_registry GROUP BY status",
}
