"""DuckDB oracle SQL for the registered queries.

Written independently of the DataFrame code: the stand-in recipes and every
stage as SQL CTEs over the pre-registered driver tables. Regex classes are
spelled out (RE2's ``\\s`` is ASCII-only); timestamps are UTC-naive.
"""

from __future__ import annotations

from workpulse.functions.text import HTML_ENTITIES, IMG_SRC_PATTERN, WS
from workpulse.params import DEFAULT_AS_OF, Params
from workpulse.sources.standins import FINISH_OFFSETS, ORDER_TEXTS

NL = "chr(10)"
NON_WS = WS.replace("[", "[^", 1)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def ts_lit(as_of: str) -> str:
    return f"TIMESTAMP {q(as_of)}"


def date_lit(as_of: str) -> str:
    return f"CAST({ts_lit(as_of)} AS DATE)"


def parse_iso(x: str) -> str:
    return f"TRY_CAST(replace(nullif({x}, ''), 'Z', '') AS TIMESTAMP)"


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, {q(rf'\A{WS}+|{WS}+\z')}, '', 'g')"


def strip_html(x: str) -> str:
    t = f"coalesce({x}, '')"
    t = f"regexp_replace({t}, {q(rf'(?i)</(div|p|li|br){WS}*>')}, {NL}, 'g')"
    t = f"regexp_replace({t}, {q(rf'(?i)<br{WS}*/?>')}, {NL}, 'g')"
    t = f"regexp_replace({t}, '<[^>]+>', '', 'g')"
    for a, b in HTML_ENTITIES:
        t = f"replace({t}, {q(a)}, {q(b)})"
    t = f"regexp_replace({t}, {q(r'[ \t]+')}, ' ', 'g')"
    t = f"regexp_replace({t}, {q(rf'\n{WS}*\n+')}, {NL}, 'g')"
    return py_strip(t)


def image_urls(x: str) -> str:
    return f"regexp_extract_all(coalesce({x}, ''), {q(IMG_SRC_PATTERN)}, 1)"


def clean_text(x: str) -> str:
    return f"lower({py_strip(x)})"


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), {q(r'[\p{L}\p{N}_]{2,}')}, 0)"


def is_blank(x: str) -> str:
    return f"coalesce({py_strip(x)} = '', true)"


def first_token(x: str) -> str:
    return f"regexp_extract(coalesce({x}, ''), {q(rf'\A{WS}*({NON_WS}+)')}, 1)"


def elapsed_days(ts: str, as_of: str) -> str:
    diff = f"(epoch_us({ts_lit(as_of)}) - epoch_us({ts}))"
    return f"CAST(coalesce(greatest(0, CAST(trunc({diff} / 86400000000.0) AS BIGINT)), 0) AS INTEGER)"


def iso_seconds(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"


# ---------------------------------------------------------------------------
# Stand-in views (same recipes as workpulse.sources.standins)
# ---------------------------------------------------------------------------

def standin_ctes(as_of: str = DEFAULT_AS_OF) -> list[tuple[str, str]]:
    offs = "[" + ", ".join(str(x) for x in FINISH_OFFSETS) + "]"
    d = date_lit(as_of)
    it = f"""
      SELECT org, n_name AS project, CAST(pos AS INTEGER) AS pos,
        CASE WHEN is_sprint THEN 'Sprint ' || CAST(k AS VARCHAR) ELSE 'Backlog' END AS name,
        CASE WHEN is_sprint THEN n_name ELSE n_name || ' Backlog' END AS path,
        CASE WHEN is_sprint AND k % 5 <> 4 THEN strftime({d} - 10, '%Y-%m-%d') || 'T00:00:00Z' END AS startDate,
        CASE WHEN is_sprint AND k % 7 <> 6 THEN strftime({d} + {offs}[k % 8 + 1], '%Y-%m-%d') || 'T00:00:00Z' END
          AS finishDate
      FROM (SELECT org, n_nationkey AS k, n_name, pos, ((pos = 0) = (n_nationkey % 6 <> 5)) AS is_sprint
            FROM nation, (VALUES ('acme'), ('beta')) AS g(org), (VALUES (0), (1)) AS i(pos))"""
    stories = """
      SELECT org, n_name AS project, c_custkey AS id,
        CASE WHEN c_custkey % 5 = 0 THEN 'Bug' ELSE 'User Story' END AS work_item_type,
        CASE c_mktsegment WHEN 'BUILDING' THEN 'Closed' WHEN 'MACHINERY' THEN 'Removed' ELSE 'Active' END AS state,
        n_name AS iteration_path
      FROM customer JOIN nation ON c_nationkey = n_nationkey
      JOIN (VALUES ('acme'), ('beta')) AS g(org) ON org = 'acme' OR c_custkey % 2 = 0"""
    links = """
      SELECT org, o_custkey AS source_id, o_orderkey AS target_id,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'System.LinkTypes.Hierarchy-Forward' END AS rel
      FROM orders JOIN (VALUES ('acme'), ('beta')) AS g(org) ON org = 'acme' OR o_orderkey % 5 = 0"""
    now = ts_lit(as_of)
    sc = f"{now} - to_days(CAST(o_orderkey * 7 % 15 AS INTEGER)) - to_hours(CAST(o_custkey % 24 AS INTEGER))"
    ch = f"{now} - to_days(CAST(o_orderkey % 9 AS INTEGER)) - to_hours(CAST(o_custkey % 24 AS INTEGER))"
    work = f"""
      SELECT org, n_name AS project, o_orderkey AS id,
        CASE WHEN org = 'beta' THEN 'Beta order ' ELSE 'Order ' END || CAST(o_orderkey AS VARCHAR) || ' (' || o_orderpriority || ')' AS title,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'Bug' ELSE 'Task' END AS work_item_type,
        CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'P' THEN ' resolved ' ELSE 'Closed' END AS state,
        n_name AS iteration_path,
        CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 13 = 1 THEN c_name WHEN c_custkey % 13 = 2 THEN ''
             WHEN c_custkey % 10 = 0 THEN '{{"displayName": "' || c_name || '"}}'
             ELSE '{{"displayName": "' || c_name || '", "uniqueName": "' || lower(c_name) || '@example.com"}}'
        END AS assigned_to,
        lq.remaining_hours, o_totalprice / CAST(2000.0 AS DOUBLE) AS original_estimate,
        CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE {iso_seconds(sc)} END AS state_change_date,
        {iso_seconds(ch)} AS changed_date
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS remaining_hours FROM lineitem GROUP BY l_orderkey) lq
        ON o_orderkey = lq.l_orderkey
      JOIN (VALUES ('acme'), ('beta')) AS g(org) ON org = 'acme' OR o_orderkey % 5 = 0"""
    eid = "CAST(event_id AS VARCHAR)"
    ots = f"({now} - to_days(CAST(day AS INTEGER)) - to_hours(CAST(o_orderkey % 5 + 1 AS INTEGER)))"
    order_text = "CASE " + " ".join(
        f"WHEN o_orderkey % 7 = {kind} AND day = {day} THEN replace({q(text)}, 'K', CAST(o_orderkey AS VARCHAR))"
        for kind, texts in ORDER_TEXTS.items() for day, text in enumerate(texts)) + " END"
    comments = f"""
      SELECT CASE WHEN event_id % 4 = 0 THEN 'beta' ELSE 'acme' END AS org,
        user_id AS work_item_id, event_id AS pos, event_id AS id,
        CASE WHEN event_id % 10 = 0 THEN NULL
             WHEN event_id % 10 = 1 THEN ''
             WHEN event_id % 10 = 2 THEN '<div>' || event_type || ' &amp;lt;ok&amp;gt; ' || props
                                         || '</div><div><br/></div><P>&nbsp;</P>'
             WHEN event_id % 10 = 3 THEN '<div>Working on ' || event_type || ' flow</div>'
                  || '<img alt="s" src="https://img.example.com/' || {eid} || '.png">'
                  || '<IMG SRC=''https://img.example.com/b' || {eid} || '.jpg''>'
             WHEN event_id % 10 = 4 THEN '<img alt=''s'' src=''https://img.example.com/' || {eid} || '.gif''>'
             ELSE '<div>Update on ' || event_type || ': ' || props || '</div><ul><li>done</li><li>next</li></ul>'
        END AS text,
        CASE WHEN event_type = 'signup' THEN '' ELSE event_type END AS author_name,
        event_type || '@example.com' AS author_email,
        CASE WHEN event_id % 53 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS createdDate,
        ts AS landed_at
      FROM events
      UNION ALL
      SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'beta' ELSE 'acme' END, o_orderkey, -(o_orderkey * 4 + day + 1),
        -(o_orderkey * 4 + day + 1), {order_text},
        'dev' || CAST(o_orderkey % 3 AS VARCHAR), 'dev@example.com', strftime({ots}, '%Y-%m-%dT%H:%M:%SZ'), {ots}
      FROM orders, (VALUES (0), (1), (2)) AS d(day) WHERE o_orderkey % 7 <> 0"""
    history = """
      SELECT 'acme' AS azure_org, user_id AS work_item_id, CAST(ts AS DATE) AS snapshot_date,
        CAST(least(10, floor(max(value) / 15)) AS INTEGER) AS comment_quality_score,
        bool_or(event_type = 'purchase') AS eod_compliant, bool_or(event_type = 'error') AS copy_paste_detected,
        max(ts) AS snapshot_timestamp
      FROM events GROUP BY user_id, CAST(ts AS DATE)"""
    return [("sv_iterations", it), ("sv_stories", stories), ("sv_links", links), ("sv_work_items", work),
            ("sv_comments", comments), ("sv_history", history)]


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


# ---------------------------------------------------------------------------
# Stage CTEs
# ---------------------------------------------------------------------------

def sprint_ctes(as_of: str) -> list[tuple[str, str]]:
    d = date_lit(as_of)
    first = """
      SELECT org, project, coalesce(name, '') AS sprint_name, coalesce(path, '') AS iteration_path,
             coalesce(startDate, '') AS start_date, coalesce(finishDate, '') AS finish_date
      FROM (SELECT *, row_number() OVER (PARTITION BY org, project ORDER BY pos) AS rn FROM sv_iterations)
      WHERE rn = 1"""
    fin = f"CAST({parse_iso('finish_date')} AS DATE)"
    sta = f"CAST({parse_iso('start_date')} AS DATE)"
    cal = f"""
      SELECT org, project, sprint_name, iteration_path, start_date, finish_date,
        CAST(CASE WHEN finish_date <> '' THEN coalesce(greatest(0, date_diff('day', {d}, {fin})), 0) ELSE 0 END
             AS INTEGER) AS days_remaining,
        CAST(CASE WHEN start_date <> '' AND finish_date <> '' AND {sta} IS NOT NULL AND {fin} IS NOT NULL
                  THEN greatest(1, date_diff('day', {sta}, {fin})) ELSE 0 END AS INTEGER) AS total_days,
        finish_date <> '' AS dates_configured
      FROM sprint_first"""
    return [("sprint_first", first), ("sprint", cal)]


def assignee_sql(raw: str) -> tuple[str, str]:
    t = py_strip(raw)
    is_obj = f"(starts_with({t}, '{{') AND ends_with({t}, '}}'))"
    empty = f"regexp_matches({raw}, {q(rf'\A{WS}*\{{{WS}*\}}{WS}*\z')})"
    falsy = f"({raw} IS NULL OR {raw} = '' OR ({is_obj} AND {empty}))"
    jv = f"json_valid({raw})"
    name = (f"CASE WHEN {falsy} THEN 'Unassigned' WHEN {is_obj} THEN "
            f"coalesce(CASE WHEN {jv} THEN json_extract_string({raw}, '$.displayName') END, '') ELSE {raw} END")
    email = (f"CASE WHEN {falsy} THEN '' WHEN {is_obj} THEN "
             f"coalesce(CASE WHEN {jv} THEN json_extract_string({raw}, '$.uniqueName') END, '') ELSE '' END")
    return name, email


def project_items_sql(as_of: str, source: str, p: Params) -> str:
    """K1 projection of work items (type filter F8) from ``source`` (org, project, id + item columns)."""
    name, email = assignee_sql("assigned_to")
    types = ", ".join(q(t) for t in p.allowed_types)
    return f"""
      SELECT org, project, id, coalesce(title, '') AS title, coalesce(work_item_type, '') AS work_item_type,
        coalesce(state, '') AS state, coalesce(iteration_path, '') AS item_iteration_path,
        {name} AS assignee_name, {email} AS assignee_email, remaining_hours, original_estimate,
        {elapsed_days(parse_iso('state_change_date'), as_of)} AS days_since_state_change,
        {elapsed_days(parse_iso('changed_date'), as_of)} AS days_since_last_update
      FROM {source} WHERE work_item_type IN ({types})"""


def discovery_ctes(as_of: str, p: Params) -> list[tuple[str, str]]:
    ptypes = ", ".join(q(t) for t in p.parent_types)
    parents = f"""
      SELECT s.* FROM sv_stories s
      WHERE s.work_item_type IN ({ptypes}) AND s.state NOT IN ('Closed', 'Removed')
        AND EXISTS (SELECT 1 FROM sprint x WHERE x.org = s.org AND x.project = s.project
                                              AND x.iteration_path = s.iteration_path)"""
    children = """
      SELECT DISTINCT p.org, p.project, l.target_id AS id
      FROM parents p JOIN sv_links l ON l.source_id = p.id AND l.org = p.org
      WHERE l.rel = 'System.LinkTypes.Hierarchy-Forward' AND l.target_id IS NOT NULL"""
    src = """(SELECT c.org, c.project, w.id, w.title, w.work_item_type, w.state, w.iteration_path, w.assigned_to,
                     w.remaining_hours, w.original_estimate, w.state_change_date, w.changed_date
              FROM sv_work_items w JOIN children c ON w.org = c.org AND w.id = c.id)"""
    return [("parents", parents), ("children", children), ("items", project_items_sql(as_of, src, p))]


def recent_sql(as_of: str, p: Params, restrict: str | None) -> str:
    where = f"AND (org, work_item_id) IN (SELECT (org, id) FROM {restrict})" if restrict else ""
    return f"""
      SELECT org, work_item_id, pos, id AS comment_id, {strip_html('text')} AS text, {image_urls('text')} AS image_urls,
        coalesce(author_name, '') AS author_name, coalesce(author_email, '') AS author_email, created_ts,
        CAST(created_ts AS DATE) = {date_lit(as_of)} AS is_today
      FROM (SELECT *, {parse_iso('createdDate')} AS created_ts FROM sv_comments
            WHERE createdDate IS NOT NULL AND createdDate <> '' {where})
      WHERE created_ts >= {ts_lit(as_of)} - to_days({p.lookback_days})"""


def rollup_ctes() -> list[tuple[str, str]]:
    ranked = """
      SELECT *, row_number() OVER (PARTITION BY org, work_item_id, is_today ORDER BY created_ts DESC, pos ASC) AS rn
      FROM recent"""
    authors = """
      SELECT org, work_item_id, nullif(string_agg(author_name, '|' ORDER BY first_rn), '') AS recent_comment_authors
      FROM (SELECT org, work_item_id, author_name, min(rn) AS first_rn FROM ranked WHERE NOT is_today
            GROUP BY org, work_item_id, author_name)
      GROUP BY org, work_item_id"""
    rollup = """
      SELECT r.org, r.work_item_id, bool_or(r.is_today) AS has_comment_today,
        CAST(count(*) FILTER (WHERE NOT r.is_today) AS INTEGER) AS recent_comment_count,
        any_value(t.text) AS today_comment_text, any_value(t.image_urls) AS today_image_urls,
        any_value(t.author_name) AS today_comment_author_name, any_value(t.author_email) AS today_comment_author_email,
        any_value(t.created_ts) AS today_comment_ts, any_value(a.recent_comment_authors) AS recent_comment_authors
      FROM recent r
      LEFT JOIN (SELECT * FROM ranked WHERE is_today AND rn = 1) t ON t.org = r.org AND t.work_item_id = r.work_item_id
      LEFT JOIN authors a ON a.org = r.org AND a.work_item_id = r.work_item_id
      GROUP BY r.org, r.work_item_id"""
    return [("ranked", ranked), ("authors", authors), ("rollup", rollup)]


def similarity_ctes(docs: str, threshold: float, prefix: str = "cp") -> list[tuple[str, str]]:
    """``docs(key, doc, is_today, text)`` -> ``{prefix}_result(key, max_sim, exact_match, copy_paste_detected)``."""
    P = prefix
    return [
        (f"{P}_d", f"SELECT key, doc, is_today, {clean_text('text')} AS clean FROM {docs} "
                   f"WHERE {clean_text('text')} <> ''"),
        (f"{P}_elig", f"SELECT key FROM {P}_d GROUP BY key HAVING bool_or(is_today) AND bool_or(NOT is_today)"),
        (f"{P}_corpus", f"SELECT * FROM {P}_d WHERE key IN (SELECT key FROM {P}_elig)"),
        (f"{P}_tf", f"SELECT key, doc, is_today, term, count(*) AS tf FROM "
                    f"(SELECT key, doc, is_today, unnest({tokens('clean')}) AS term FROM {P}_corpus) "
                    f"GROUP BY key, doc, is_today, term"),
        (f"{P}_n", f"SELECT key, count(*) AS n_docs FROM {P}_corpus GROUP BY key"),
        (f"{P}_df", f"SELECT key, term, count(*) AS df FROM {P}_tf GROUP BY key, term"),
        (f"{P}_w", f"SELECT t.key, t.doc, t.is_today, t.term, "
                   f"t.tf * (ln((n.n_docs + 1) / (f.df + 1)) + 1.0) AS w "
                   f"FROM {P}_tf t JOIN {P}_df f ON t.key = f.key AND t.term = f.term JOIN {P}_n n ON t.key = n.key"),
        (f"{P}_norms", f"SELECT key, doc, sqrt(sum(w * w)) AS norm FROM {P}_w GROUP BY key, doc"),
        (f"{P}_dots", f"SELECT p.key, p.doc, sum(p.w * t.w) AS dot FROM {P}_w p JOIN {P}_w t "
                      f"ON p.key = t.key AND p.term = t.term AND t.is_today WHERE NOT p.is_today "
                      f"GROUP BY p.key, p.doc"),
        (f"{P}_tnorm", f"SELECT n.key, n.norm AS t_norm FROM {P}_norms n JOIN {P}_d d "
                       f"ON n.key = d.key AND n.doc = d.doc AND d.is_today"),
        (f"{P}_cos", f"SELECT x.key, CASE WHEN n.norm > 0 AND t.t_norm > 0 THEN x.dot / (n.norm * t.t_norm) END AS cos "
                     f"FROM {P}_dots x JOIN {P}_norms n ON x.key = n.key AND x.doc = n.doc "
                     f"JOIN {P}_tnorm t ON x.key = t.key"),
        (f"{P}_best", f"SELECT key, max(cos) AS max_sim FROM {P}_cos GROUP BY key"),
        (f"{P}_exact", f"SELECT DISTINCT p.key FROM {P}_d p JOIN {P}_d t ON p.key = t.key AND t.is_today "
                       f"AND NOT p.is_today AND p.clean = t.clean"),
        (f"{P}_result", f"SELECT e.key, coalesce(b.max_sim, 0.0) AS max_sim, x.key IS NOT NULL AS exact_match, "
                        f"(x.key IS NOT NULL OR coalesce(b.max_sim, 0.0) >= {threshold}) AS copy_paste_detected "
                        f"FROM {P}_elig e LEFT JOIN {P}_best b ON e.key = b.key LEFT JOIN {P}_exact x ON e.key = x.key"),
    ]


def gate_ctes(as_of: str, p: Params, tasks: str = "tasks0") -> list[tuple[str, str]]:
    active = ", ".join(q(s) for s in p.active_states)
    before = f"AND snapshot_date < {date_lit(as_of)}" if p.history_before_as_of else ""
    latest = f"""
      SELECT azure_org, work_item_id, snapshot_date AS latest_date, comment_quality_score AS latest_score,
        (eod_compliant AND NOT copy_paste_detected AND comment_quality_score >= {p.good_threshold}) AS is_good
      FROM (SELECT *, row_number() OVER (PARTITION BY azure_org, work_item_id
                                         ORDER BY snapshot_date DESC, snapshot_timestamp DESC) AS rn
            FROM sv_history
            WHERE eod_compliant AND comment_quality_score IS NOT NULL {before}
              AND (azure_org, work_item_id) IN (SELECT (org, id) FROM {tasks} WHERE state_norm = {q(p.gate)}))
      WHERE rn = 1"""
    yesterday = f"AND l.latest_date = {date_lit(as_of)} - 1" if p.gate_policy == "yesterday" else ""
    branched = f"""
      SELECT t.*, CASE WHEN t.state_norm NOT IN ({active}) THEN 'skipped_state'
                       WHEN t.state_norm = {q(p.gate)} AND coalesce(l.is_good {yesterday}, false) THEN 'skipped_history'
                       ELSE 'analysed' END AS branch
      FROM {tasks} t LEFT JOIN latest l ON l.azure_org = t.org AND l.work_item_id = t.id"""
    return [("latest", latest), ("branched", branched)]


def rubric_sql(text: str, title: str) -> dict[str, str]:
    """G3 rubric as SQL expressions keyed by output field."""
    from workpulse.operators.grading import (BLOCKER_PHRASES, DONE_WORDS, LEFT_WORDS, NO_BLOCKER_PHRASES,
                                             RISK_WORDS, RUBRIC_FOLLOWUP, VAGUE_PHRASES, WORD_PATTERN,
                                             MISSING_FOLLOWUP)
    toks = f"regexp_extract_all(lower(coalesce({text}, '')), {q(WORD_PATTERN)}, 0)"
    words = f"len({toks})"
    norm = f"(' ' || array_to_string({toks}, ' ') || ' ')"
    has_ph = lambda phs: "(" + " OR ".join(f"contains({norm}, {q(' ' + ph + ' ')})" for ph in phs) + ")"
    lst = lambda ws: "[" + ", ".join(q(w) for w in ws) + "]"
    vague = f"({words} <= 5 AND {has_ph(VAGUE_PHRASES)})"
    done = f"list_has_any({toks}, {lst(DONE_WORDS)})"
    left = f"list_has_any({toks}, {lst(LEFT_WORDS)})"
    risk = f"list_has_any({toks}, {lst(RISK_WORDS)})"
    b = lambda c, v: f"(CASE WHEN {c} THEN {v} ELSE 0 END)"
    has_digit = f"regexp_matches(coalesce({text}, ''), '[0-9]')"
    raw = (f"(1 + {b(done, 2)} + {b(left, 2)} + {b(risk, 1)} + {b(f'{words} >= 12', 2)} + {b(f'{words} >= 25', 1)}"
           f" + {b(has_digit, 1)})")
    score = f"(CASE WHEN {vague} THEN least(3, greatest(0, {words} - 1)) ELSE least(10, {raw}) END)"
    label = f"(CASE WHEN {score} >= 8 THEN 'excellent' WHEN {score} >= 5 THEN 'good' ELSE 'vague' END)"
    blocker = f"({has_ph(BLOCKER_PHRASES)} OR ({has_ph(('blocker', 'blockers'))} AND NOT {has_ph(NO_BLOCKER_PHRASES)}))"
    sentiment = f"(CASE WHEN {blocker} THEN 'negative' WHEN {score} >= 7 THEN 'positive' ELSE 'neutral' END)"
    blank = is_blank(text)
    pre, post = RUBRIC_FOLLOWUP.split("%s")
    mpre, mpost = MISSING_FOLLOWUP.split("%s")
    return {
        "quality_score": f"CAST(CASE WHEN {blank} THEN 0 ELSE {score} END AS INTEGER)",
        "quality_label": f"CASE WHEN {blank} THEN 'missing' ELSE {label} END",
        "blocker_detected": f"CASE WHEN {blank} THEN false ELSE {blocker} END",
        "progress_detectable": f"CASE WHEN {blank} THEN false ELSE {done} END",
        "sentiment": f"CASE WHEN {blank} THEN 'neutral' ELSE {sentiment} END",
        "suggested_followup": f"CASE WHEN {blank} THEN {q(mpre)} || {title} || {q(mpost)} "
                              f"ELSE {q(pre)} || {title} || {q(post)} END",
    }


def risk_sql(p: Params, ds="days_since_state_change", du="days_since_last_update", rem="remaining_hours",
             orig="original_estimate", qs="quality_score", cp="copy_paste_detected", bl="blocker_detected",
             dr="days_remaining", dc="dates_configured", has="has_comment_today") -> dict[str, str]:
    dbl = lambda v: f"CAST({v} AS DOUBLE)"
    norm = lambda v, m: f"least({dbl(1)}, greatest({dbl(0)}, {dbl(v)} / {dbl(m)}))"
    stale = f"(coalesce({rem} >= {orig}, false) OR {du} >= 3)"
    s1 = norm(ds, 10)
    s2 = norm(f"CASE WHEN {stale} THEN {du} ELSE 0 END", 7)
    s3 = norm(f"greatest(0, 10 - {qs})", 10)
    s4 = f"CASE WHEN {cp} THEN {dbl(1)} ELSE {dbl(0)} END"
    s5 = f"CASE WHEN {bl} THEN {dbl(1)} ELSE {dbl(0)} END"
    s6 = (f"CASE WHEN {dc} THEN (CASE WHEN {dr} = 0 THEN {dbl(1.0)} WHEN {dr} <= 2 THEN {dbl(0.75)} "
          f"WHEN {dr} <= 5 THEN {dbl(0.4)} ELSE {dbl(0)} END) ELSE {dbl(0)} END")
    w = [dbl(x) for x in p.weights]
    raw = f"(({s1}) * {w[0]} + ({s2}) * {w[1]} + ({s3}) * {w[2]} + ({s4}) * {w[3]} + ({s5}) * {w[4]} + ({s6}) * {w[5]}) * {dbl(100.0)}"
    score = f"CAST(round_even({raw}, 0) AS INTEGER)"
    cuts = " ".join(f"WHEN {score} <= {c} THEN {q(lab)}" for c, lab in p.label_cuts)
    label = f"(CASE {cuts} ELSE 'Critical' END)"
    low, second = p.label_cuts[0][1], p.label_cuts[1][1]
    label2 = f"CASE WHEN NOT {has} AND {label} = {q(low)} THEN {q(second)} ELSE {label} END"
    return {"hours_stale": stale, "risk_score": score, "risk_label": label2}


def attention_sql(p: Params, state="state_norm", has="has_comment_today", qs="quality_score",
                  cp="copy_paste_detected", bl="blocker_detected", score="risk_score") -> dict[str, str]:
    gate = f"({state} = {q(p.gate)} AND (NOT {has} OR {qs} < {p.good_threshold} OR {cp}))"
    att = f"({score} >= {p.flag_threshold} OR {bl} OR NOT {has} OR {qs} < 5 OR {cp} OR {gate})"
    return {"quality_gate_triggered": gate, "needs_attention": att}


def nudge_sql() -> dict[str, str]:
    from workpulse.operators.nudge import (FALLBACK_MESSAGE, ISSUE_BLOCKER, ISSUE_COPIED, ISSUE_HOURS, ISSUE_NO_COMMENT,
                                           ISSUE_RISK, ISSUE_VAGUE, ISSUES_DEFAULT)
    first = f"CASE WHEN {first_token('assignee_name')} = '' THEN 'Developer' ELSE {first_token('assignee_name')} END"
    rp, rs = ISSUE_RISK.split("%s")
    issues = (f"coalesce(nullif(concat_ws('; ', "
              f"CASE WHEN NOT has_comment_today THEN {q(ISSUE_NO_COMMENT)} WHEN quality_label = 'missing' "
              f"THEN {q(ISSUE_NO_COMMENT)} WHEN quality_label = 'copy-pasted' THEN {q(ISSUE_COPIED)} "
              f"WHEN quality_label = 'vague' THEN {q(ISSUE_VAGUE)} END, "
              f"CASE WHEN blocker_detected THEN {q(ISSUE_BLOCKER)} END, "
              f"CASE WHEN hours_stale THEN {q(ISSUE_HOURS)} END, "
              f"CASE WHEN risk_label IN ('At Risk', 'Critical') THEN {q(rp)} || risk_label || {q(rs)} END), ''), "
              f"{q(ISSUES_DEFAULT)})")
    parts = FALLBACK_MESSAGE.split("%s")
    return {"first_name": first, "issues": issues,
            "message": lambda f, t, i: f"{q(parts[0])} || {f} || {q(parts[1])} || {t} || {q(parts[2])} || {i} || {q(parts[3])}"}


def pipeline_ctes(as_of: str = DEFAULT_AS_OF, p: Params = Params(), data_as_of: str = DEFAULT_AS_OF
                  ) -> list[tuple[str, str]]:
    """Whole daily run (rubric grader, fallback nudges) ending in ``final``: one row per task.

    ``data_as_of`` fixes the landed stand-in data; ``as_of`` is the run time.
    """
    ctes = standin_ctes(data_as_of) + sprint_ctes(as_of) + discovery_ctes(as_of, p)
    ctes.append(("recent", recent_sql(as_of, p, "items")))
    ctes += rollup_ctes()
    state_norm = f"lower({py_strip('coalesce(i.state, ' + q('') + ')')})"
    tasks0 = f"""
      SELECT i.*, coalesce(r.has_comment_today, false) AS has_comment_today, r.today_comment_text,
        coalesce(r.today_image_urls, []::VARCHAR[]) AS today_image_urls, r.today_comment_author_name,
        r.today_comment_author_email, r.today_comment_ts, coalesce(r.recent_comment_count, 0) AS recent_comment_count,
        r.recent_comment_authors, s.sprint_name, s.iteration_path, s.start_date, s.finish_date, s.days_remaining,
        s.total_days, s.dates_configured, {state_norm} AS state_norm
      FROM items i LEFT JOIN rollup r ON r.org = i.org AND r.work_item_id = i.id
      JOIN sprint s ON s.org = i.org AND s.project = i.project"""
    ctes.append(("tasks0", tasks0))
    ctes += gate_ctes(as_of, p, "tasks0")
    docs = """
      SELECT org || '/' || CAST(work_item_id AS VARCHAR) AS key, pos AS doc, is_today, text FROM ranked
      WHERE (NOT is_today OR rn = 1) AND (org, work_item_id) IN (SELECT (org, id) FROM branched WHERE branch = 'analysed')"""
    ctes.append(("pdocs", docs))
    ctes += similarity_ctes("pdocs", p.copy_paste_threshold, "cp")
    g = rubric_sql("b.today_comment_text", "b.title")
    graded = f"""
      SELECT b.*, coalesce(c.copy_paste_detected, false) AND b.branch = 'analysed' AS copied,
        {g['quality_score']} AS g_score, {g['quality_label']} AS g_label, {g['blocker_detected']} AS g_blocker,
        {g['progress_detectable']} AS g_progress, {g['sentiment']} AS g_sentiment,
        {g['suggested_followup']} AS g_followup
      FROM branched b LEFT JOIN cp_result c ON c.key = b.org || '/' || CAST(b.id AS VARCHAR)"""
    ctes.append(("graded", graded))
    an = "branch = 'analysed'"
    analysis = f"""
      SELECT * EXCLUDE (g_score, g_label, g_blocker, g_progress, g_sentiment, g_followup, copied),
        ({an} AND has_comment_today) AS eod_compliant,
        CASE WHEN {an} THEN g_score ELSE 0 END AS quality_score,
        CASE WHEN {an} THEN (CASE WHEN copied AND g_label <> 'missing' THEN 'copy-pasted' ELSE g_label END)
             ELSE 'skipped' END AS quality_label,
        CASE WHEN {an} THEN g_blocker ELSE false END AS blocker_detected,
        CASE WHEN {an} THEN g_progress ELSE false END AS progress_detectable,
        CASE WHEN {an} THEN g_sentiment ELSE 'neutral' END AS sentiment,
        CASE WHEN {an} THEN g_followup ELSE '' END AS suggested_followup,
        copied AS copy_paste_detected
      FROM graded"""
    ctes.append(("analysis", analysis))
    r = risk_sql(p)
    scored = f"""
      SELECT *, CASE WHEN {an} THEN {r['hours_stale']} ELSE false END AS hours_stale,
        CASE WHEN {an} THEN {r['risk_score']} ELSE 0 END AS risk_score,
        CASE WHEN {an} THEN {r['risk_label']} ELSE {q(p.label_cuts[0][1])} END AS risk_label
      FROM analysis"""
    ctes.append(("scored", scored))
    a = attention_sql(p)
    flagged = f"""
      SELECT *, {an} AND {a['quality_gate_triggered']} AS quality_gate_triggered,
        {an} AND {a['needs_attention']} AS needs_attention
      FROM scored"""
    ctes.append(("flagged", flagged))
    n = nudge_sql()
    final = f"""
      SELECT *, CASE WHEN needs_attention THEN 'gentle' END AS nudge_tone,
        CASE WHEN needs_attention THEN {n['message']('first_name', 'title', 'issues')} END AS nudge_message
      FROM (SELECT *, {n['first_name']} AS first_name, {n['issues']} AS issues FROM flagged)"""
    ctes.append(("final", final))
    return ctes


SNAPSHOT_SELECT = """
  CAST({date} AS DATE) AS snapshot_date, {ts} AS snapshot_timestamp, org AS azure_org, project AS azure_project,
  sprint_name, iteration_path, CAST({start} AS DATE) AS sprint_start_date, CAST({finish} AS DATE) AS sprint_finish_date,
  days_remaining AS sprint_days_remaining, CAST(id AS INTEGER) AS work_item_id, title AS task_title, work_item_type,
  state AS task_state, assignee_name, nullif(assignee_email, '') AS assignee_email, remaining_hours, original_estimate,
  days_since_state_change, days_since_last_update, has_comment_today,
  nullif(today_comment_text, '') AS today_comment_text, today_comment_author_name, today_comment_author_email,
  today_comment_ts AS today_comment_timestamp, nullif(array_to_string(today_image_urls, '|'), '') AS today_comment_image_urls,
  recent_comment_count, recent_comment_authors, quality_score AS comment_quality_score,
  quality_label AS comment_quality_label, copy_paste_detected, blocker_detected, hours_stale,
  nullif(sentiment, '') AS sentiment, nullif(suggested_followup, '') AS ai_suggested_followup, risk_score, risk_label,
  needs_attention, eod_compliant, nullif(nudge_tone, '') AS nudge_tone, nullif(nudge_message, '') AS nudge_message"""


def snapshot_select(as_of: str) -> str:
    return SNAPSHOT_SELECT.format(date=date_lit(as_of), ts=ts_lit(as_of), start=parse_iso("start_date"),
                                  finish=parse_iso("finish_date"))
