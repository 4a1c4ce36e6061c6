"""The same answers as plain SQL over the flat tables: an independent check.

No JSON is built or parsed here, except for the two functions about JSON.
"""

from __future__ import annotations

from ticketmill.workload.raw import HISTORY_FIELDS

_NOBODY = "sha256(chr(31))"
_FIELDS = "[" + ", ".join(f"'{name}'" for name in HISTORY_FIELDS) + "]"

_CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "pj": (
        """
        SELECT c_custkey AS c, c_name, 'P' || c_custkey AS key,
               CASE WHEN c_custkey % 29 <> 28 THEN c_name END AS name,
               CASE c_custkey % 3 WHEN 0 THEN 'software' WHEN 1 THEN 'business' ELSE '' END
                   AS project_type_key,
               c_custkey % 7 = 0 AS archived,
               CASE WHEN c_custkey % 6 <> 5 THEN CAST(n_nationkey AS VARCHAR) END
                   AS project_category_id,
               CASE WHEN c_custkey % 6 <> 5 THEN n_name END AS project_category_name,
               CASE WHEN c_custkey % 6 <> 5 THEN r_name END AS project_category_description,
               sha256(CASE WHEN c_custkey % 13 = 12 THEN '' ELSE c_name END || chr(31) ||
                      CASE WHEN c_custkey % 13 IN (11, 12) THEN '' ELSE 'u' || c_nationkey END)
                   AS lead_hash,
               CASE WHEN c_custkey % 24 = 23 THEN 'id is not an integer'
                    WHEN c_custkey % 29 = 28 THEN 'name is missing' END AS reason
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        WHERE c_custkey % 11 NOT IN (9, 10)""",
        (),
    ),
    "ok_pj": ("SELECT * FROM pj WHERE reason IS NULL", ("pj",)),
    "rl": (
        """
        SELECT c, key, j, c * 10 + j AS n,
               CASE WHEN j = 2 AND c % 5 = 0 THEN '' ELSE 'v' || j END AS release_name,
               (c + j) % 9 = 0 AS archived, j % 2 = 0 AS released,
               CASE (c + j) % 4 WHEN 3 THEN NULL
                    WHEN 2 THEN CAST(d AS TIMESTAMP) + INTERVAL 825 MINUTE
                    ELSE CAST(d AS TIMESTAMP) END AS release_date,
               CASE WHEN j <> 1 THEN CAST(d AS TIMESTAMP) END AS user_release_date,
               CASE WHEN (c * 10 + j) % 97 = 0 THEN 'id is not an integer'
                    WHEN (c + j) % 9 = 8 THEN 'archived is not a boolean'
                    WHEN (c + j) % 31 = 0 THEN 'unknown date form' END AS reason
        FROM (SELECT c, key, j,
                     DATE '1969-01-01' + CAST((c * 7919 + j * 104729) % 36000 AS INTEGER) AS d
              FROM (SELECT c, key, unnest(range(c % 4)) AS j FROM ok_pj))""",
        ("ok_pj",),
    ),
    "bd": (
        """
        SELECT c, key, name AS project_name, k, c * 4 + k AS n,
               CASE WHEN (c + k) % 17 = 16 THEN '' ELSE 'Board ' || k || ' of ' || c_name END
                   AS board_name,
               CASE k WHEN 0 THEN 'scrum' WHEN 2 THEN '' ELSE 'kanban' END AS board_type,
               CASE WHEN (c * 4 + k) % 53 = 52 THEN 'id is not an integer' END AS reason
        FROM (SELECT *, unnest(range(4)) AS k FROM ok_pj)""",
        ("ok_pj",),
    ),
    "every_entry": (
        """
        SELECT *, listed_in * 4 + l_suppkey % 4 AS board_id,
               CASE WHEN l_orderkey % 43 = 42 THEN ''
                    WHEN l_orderkey % 41 = 40 THEN 'y' || l_orderkey
                    ELSE CAST(l_orderkey AS VARCHAR) END AS issue_ref,
               l_linenumber * 1000000000000000 + l_partkey * 10000
                   + date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS ord,
               CASE WHEN l_orderkey % 4 <> 3 THEN o_orderdate END AS created,
               CASE WHEN l_partkey % 23 <> 0 THEN l_shipdate + to_hours(l_linenumber) END
                   AS updated
        FROM (SELECT *, unnest(CASE WHEN l_partkey % 50 = 0 THEN [o_custkey, o_custkey + 1]
                                    ELSE [o_custkey] END) AS listed_in
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
        (),
    ),
    "entry": (
        """
        SELECT e.*, b.c, b.key AS project_key, b.project_name, b.k,
               CASE WHEN issue_ref = '' THEN 'id is blank'
                    WHEN l_orderkey % 41 = 40 THEN 'id is not an integer'
                    WHEN l_orderkey % 47 = 46 AND l_linenumber % 2 = 0 THEN 'key is missing'
                    WHEN l_partkey % 10 = 0 AND l_partkey % 7 = 2
                        THEN 'epic_done is not a boolean' END AS reason
        FROM every_entry e JOIN bd b ON e.board_id = b.n AND b.reason IS NULL""",
        ("every_entry", "bd"),
    ),
    "winner": (
        """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY c, issue_ref,
                                         CASE WHEN issue_ref = '' THEN (k, ord) END
                                         ORDER BY k, ord) AS place FROM entry) WHERE place = 1""",
        ("entry",),
    ),
    "iss": ("SELECT * FROM winner WHERE reason IS NULL", ("winner",)),
    "hist": (
        f"""
        SELECT *, l_orderkey * 10 + i AS transition_id, ({_FIELDS})[i] AS own,
               CASE WHEN i IN (3, 7) OR (l_orderkey + i) % 9 = 0 THEN
                    CASE i WHEN 7 THEN 'Link' WHEN 3 THEN 'Attachment' ELSE 'status' END
               END AS extra,
               CASE WHEN l_suppkey % 5 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS old_id,
               CASE WHEN l_partkey % 3 <> 0 THEN l_linestatus END AS new_text
        FROM (SELECT *, unnest(range(1, l_linenumber + 1)) AS i FROM iss)
        WHERE (l_orderkey + i) % 61 <> 0""",
        ("iss",),
    ),
    "tr": (
        """
        SELECT transition_id, field AS transition_field, kind AS transition_field_type,
               l_orderkey AS issue_id, 'P' || o_custkey || '-' || l_orderkey AS issue_key,
               sha256('S' || l_suppkey || chr(31) ||
                      CASE WHEN l_suppkey % 4 = 0 THEN 'k' ELSE 's' END || l_suppkey)
                   AS hashed_author,
               CASE WHEN i <> 6 THEN epoch_us(l_shipdate + to_days(CAST(i AS INTEGER))) END
                   AS created_us,
               CASE WHEN field <> 'assignee' THEN old_id END AS from_id,
               CASE WHEN field = 'assignee'
                    THEN sha256(l_returnflag || chr(31) || coalesce(old_id, ''))
                    ELSE l_returnflag END AS from_string,
               CASE WHEN field <> 'assignee' THEN CAST(l_partkey AS VARCHAR) END AS to_id,
               CASE WHEN field = 'assignee'
                    THEN sha256(coalesce(new_text, '') || chr(31) || l_partkey)
                    ELSE new_text END AS to_string,
               c AS project_id, i AS hist_ord, item_ord
        FROM (SELECT *, own AS field, CASE WHEN i = 2 THEN '' ELSE 'core' END AS kind,
                     0 AS item_ord FROM hist
              UNION ALL
              SELECT *, extra, 'second', 1 FROM hist WHERE extra IS NOT NULL)
        WHERE field <> 'Attachment'""",
        ("hist",),
    ),
    "ids": (
        """
        SELECT 'projects' AS data_type, CAST(c AS VARCHAR) AS entity FROM ok_pj
        UNION ALL SELECT 'releases', c || '/' || n FROM rl WHERE reason IS NULL
        UNION ALL SELECT 'boards', c || '/' || n FROM bd WHERE reason IS NULL
        UNION ALL SELECT 'issues', c || '/' || l_orderkey FROM iss
        UNION ALL SELECT 'transitions', issue_id || '/' || transition_id || '/' || transition_field
                  FROM tr""",
        ("ok_pj", "rl", "bd", "iss", "tr"),
    ),
    "loaded": (
        """
        SELECT data_type, count(DISTINCT k) AS n FROM (
            SELECT 'projects' AS data_type, CAST(c AS VARCHAR) AS k FROM ok_pj
            UNION ALL SELECT 'releases', CAST(n AS VARCHAR) FROM rl WHERE reason IS NULL
            UNION ALL SELECT 'boards', CAST(n AS VARCHAR) FROM bd WHERE reason IS NULL
            UNION ALL SELECT 'issues', CAST(l_orderkey AS VARCHAR) FROM iss
            UNION ALL SELECT 'transitions',
                issue_id || '/' || transition_id || '/' || transition_field FROM tr)
        GROUP BY data_type""",
        ("ok_pj", "rl", "bd", "iss", "tr"),
    ),
}


def _with(sql: str, *names: str) -> str:
    """The statement behind the common tables it needs, each after its own needs."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in _CTES[name][1]:
            need(other)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    ctes = ",\n".join(f"{name} AS ({_CTES[name][0]})" for name in order)
    return f"WITH {ctes}\n{sql}"


def _in_range(created: str = "created", updated: str = "updated") -> str:
    return (
        f"(coalesce({created} >= TIMESTAMP '1996-01-01', false) "
        f"OR coalesce({updated} >= TIMESTAMP '1996-01-01', false)) "
        f"AND (coalesce({created} <= TIMESTAMP '1999-12-31', false) "
        f"OR coalesce({updated} <= TIMESTAMP '1999-12-31', false))"
    )


_PROJECTS = """SELECT c AS id, key, name, project_type_key, archived, project_category_id,
    project_category_name, project_category_description, lead_hash FROM ok_pj"""
_RELEASES = """SELECT n AS release_id, release_name, c AS project_id, key AS project_key, archived,
    released, epoch_us(release_date) AS release_date_us,
    epoch_us(user_release_date) AS user_release_date_us FROM rl WHERE reason IS NULL"""
_BOARDS = """SELECT n AS board_id, c AS project_id, board_name AS name, board_type
    FROM bd WHERE reason IS NULL"""
_LABELS = """CASE WHEN l_linenumber <> 6 THEN o_orderpriority || ', ' || l_returnflag END"""
_DONE = """CASE WHEN l_partkey % 10 = 0 AND l_partkey % 7 = 0 THEN true
    WHEN l_partkey % 10 = 0 AND l_partkey % 7 = 1 THEN false END"""
_ISSUES = f"""SELECT l_orderkey AS id, 'P' || o_custkey || '-' || l_orderkey AS key,
    c AS project_id, project_key, project_name,
    CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS BIGINT) END AS issuetype_id,
    'Type ' || l_linenumber AS issue_type,
    CASE WHEN l_linenumber % 5 = 0 THEN l_partkey END AS parent_task_id,
    CASE WHEN l_linenumber % 5 = 0 THEN 'P-' || l_partkey END AS parent_task_key,
    substr(o_orderpriority, 3) AS priority,
    CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority_id,
    CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT) AS status_id,
    o_orderstatus AS status_name,
    CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS BIGINT) AS status_category_id,
    'Cat ' || o_orderstatus AS status_category_name,
    CASE o_orderstatus WHEN 'F' THEN 'green' WHEN 'O' THEN 'yellow' END AS status_category_colour,
    CASE WHEN l_partkey % 10 = 0 THEN l_suppkey END AS epic_id,
    CASE WHEN l_partkey % 10 = 0 THEN 'E-' || l_suppkey END AS epic_key,
    CASE WHEN l_partkey % 10 = 0 THEN l_returnflag END AS epic_name,
    CASE WHEN l_partkey % 10 = 0 AND l_partkey % 4 <> 0 THEN 'about ' || l_returnflag END
        AS epic_summary,
    {_DONE} AS epic_done,
    'Order ' || l_orderkey || ' line ' || l_linenumber AS summary,
    {_LABELS} AS labels, epoch_us(created) AS created_us, epoch_us(updated) AS updated_us
    FROM iss"""
_TRANSITIONS = "SELECT * EXCLUDE (project_id, hist_ord, item_ord) FROM tr"
_SPRINTS = "'[' || array_to_string([ '\"s' || x || '\"' for x in range(1, l_linenumber + 1)], ',') || ']'"
_TYPE_OF_WORK = """CASE WHEN l_partkey % 3 = 0 THEN 'feature'
    WHEN l_partkey % 2 = 0 THEN 'opt' || l_linenumber
    WHEN l_partkey % 3 = 1 THEN '{"id":' || l_suppkey || ',"value":""}'
    ELSE '{"id":' || l_suppkey || '}' END"""
_READBACK = _ISSUES.removesuffix("FROM iss") + f""",
    'Team "' || l_returnflag || '"' AS team, {_SPRINTS} AS sprints FROM iss"""
_PAGE = """SELECT o_orderkey, o_orderkey // 600 AS r, (o_orderkey % 600) // 150 AS page,
    row_number() OVER (PARTITION BY o_orderkey // 150 ORDER BY o_orderkey) - 1 AS pos
    FROM orders"""
_FIRST_LOADS = """SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY transition_id, issue_id, transition_field
    ORDER BY project_id, hist_ord, item_ord) AS place FROM tr) WHERE place = 1"""
_REJECTS = """SELECT relation, reason, count(*) AS rejects FROM (
                SELECT 'projects' AS relation, reason FROM pj
                UNION ALL SELECT 'releases', reason FROM rl
                UNION ALL SELECT 'boards', reason FROM bd
                UNION ALL SELECT 'issues', reason FROM winner)
            WHERE reason IS NOT NULL GROUP BY relation, reason"""
_RECORDS = "SELECT data_type, count(*) AS records FROM ids GROUP BY data_type"


def _identity(name: str) -> str:
    return _with(f"SELECT entity FROM ids WHERE data_type = '{name}'", "ids")


def oracle_sql() -> dict[str, str]:
    words = "['true', 'TRUE', '1', 'Yes', 'false', 'False', '0', 'NO', 'maybe', 't']"
    return {
        "p1_projects": _with(_PROJECTS, "ok_pj"),
        "p2_releases": _with(_RELEASES, "rl"),
        "p3_boards": _with(_BOARDS, "bd"),
        "p4_issues": _with(_ISSUES, "iss"),
        "p5_transitions": _with(_TRANSITIONS, "tr"),
        "v_projects_good": _identity("projects"),
        "v_releases_good": _identity("releases"),
        "v_boards_good": _identity("boards"),
        "v_issues_good": _identity("issues"),
        "v_transitions_good": _identity("transitions"),
        "s7_readback_parquet": _with(_READBACK, "iss"),
        "s7_readback_csv": _with(_READBACK, "iss"),
        "s7_readback_jsonl": _with(_READBACK, "iss"),
        "s1_paged_scan": f"""SELECT r AS request, 150 * page + pos AS place,
            CAST(o_orderkey AS VARCHAR) AS item FROM ({_PAGE})
            WHERE CASE r % 4 WHEN 0 THEN true WHEN 1 THEN page <= 2 WHEN 2 THEN page < 1
                  ELSE page <= 1 END""",
        "s1_torn_pages": f"""SELECT 'item' AS kind, r AS request, CAST(o_orderkey AS VARCHAR) AS value
            FROM ({_PAGE}) WHERE CASE r % 4 WHEN 0 THEN true WHEN 1 THEN page <= 2 WHEN 2 THEN page < 1
                  ELSE page <= 1 END AND NOT (r % 6 = 0 AND page = 2)
            UNION ALL SELECT DISTINCT 'torn', r, 'line is no readable page' FROM ({_PAGE})
            WHERE r % 6 = 0 AND page = 2""",
        "t4_stop_across_batches": f"""SELECT r AS request, 150 * page + pos AS place,
            CAST(o_orderkey AS VARCHAR) AS item FROM ({_PAGE})
            WHERE CASE r % 4 WHEN 0 THEN true WHEN 1 THEN page <= 2 WHEN 2 THEN page < 1
                  ELSE page <= 1 END""",
        "s1b_page_audit": f"""
            WITH p AS (SELECT r, page, 150 * page - CASE WHEN r % 7 = 0 AND page = 3 THEN 50 ELSE 0 END
                              AS start,
                              CASE WHEN r % 4 = 2 AND page = 1 THEN 0 ELSE count(*) END
                           AS n FROM ({_PAGE}) GROUP BY r, page),
            kept AS (SELECT * FROM p WHERE NOT (r % 5 = 0 AND page = 1) AND NOT (r % 12 = 1 AND page = 2)),
            gaps AS (SELECT *, coalesce(max(start + n) OVER (PARTITION BY r ORDER BY start
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach FROM kept),
            a AS (SELECT r, count(*) AS pages,
                         CAST(sum(greatest(start + n - greatest(reach, start), 0)) AS BIGINT) AS received,
                         bool_or(n = 0 OR (r % 4 = 1 AND page = 2)) AS stopped,
                         CAST(CASE r % 4 WHEN 0 THEN 600 WHEN 3 THEN 300 END AS BIGINT)
                             AS announced,
                         CAST(sum(CASE WHEN start > reach THEN 1 ELSE 0 END) AS BIGINT) AS gaps
                  FROM gaps GROUP BY r)
            SELECT r AS request, pages, received, announced, gaps,
                   gaps = 0 AND coalesce(received >= announced, stopped) AS complete FROM a""",
        "s2_projects_by_key": """SELECT CASE WHEN c_custkey % 24 = 23 THEN 'x' ELSE '' END
            || c_custkey AS id, 'P' || c_custkey AS key FROM customer
            WHERE c_mktsegment = 'BUILDING'""",
        "s3_project_details": """SELECT CASE WHEN c_custkey % 24 = 23 THEN 'x' ELSE '' END
            || c_custkey AS entity_id, 'P' || c_custkey AS key,
            '/rest/api/2/project/' || c_custkey AS path,
            CASE WHEN c_custkey % 13 <> 12 THEN c_name END AS lead_name, c_custkey % 4 AS versions
            FROM customer WHERE c_custkey % 11 NOT IN (9, 10)""",
        "s4_boards_scan": """SELECT 'P' || c_custkey AS project_key, k AS place,
            CASE WHEN (c_custkey * 4 + k) % 53 = 52 THEN 'b' ELSE '' END || (c_custkey * 4 + k)
                AS board
            FROM (SELECT c_custkey, unnest(range(4)) AS k FROM customer)""",
        "s5_issues_scan": _with(
            f"""SELECT board_id, nullif(issue_ref, '') AS issue_ref, epoch_us(updated) AS updated_us
            FROM every_entry WHERE {_in_range()}""",
            "every_entry",
        ),
        "s6_run_relations": _with("SELECT data_type, entity FROM ids", "ids"),
        "f3_selected_relations": _with(
            "SELECT data_type, entity FROM ids WHERE data_type IN ('boards', 'releases')", "ids"
        ),
        "f1_date_range": _with(
            f""", ranged AS (SELECT * FROM entry WHERE {_in_range()} AND issue_ref <> '')
            SELECT l_orderkey AS id, c AS project_id, epoch_us(created) AS created_us,
                   epoch_us(updated) AS updated_us
            FROM (SELECT *, row_number() OVER (PARTITION BY c, issue_ref ORDER BY k, ord) AS place
                  FROM ranged) WHERE place = 1 AND reason IS NULL""",
            "entry",
        ),
        "f4_tracked_fields": _with(
            f"""SELECT field, count(*) AS items FROM (
                SELECT ({_FIELDS})[i] AS field FROM h
                UNION ALL SELECT CASE i WHEN 7 THEN 'Link' WHEN 3 THEN 'Attachment'
                    ELSE 'status' END FROM h WHERE i IN (3, 7) OR (l_orderkey + i) % 9 = 0)
            WHERE field <> 'Attachment' GROUP BY field""",
            "every_entry",
        ).replace(
            "\nSELECT field",
            ", h AS (SELECT *, unnest(range(1, l_linenumber + 1)) AS i FROM every_entry)\n"
            "SELECT field",
        ),
        "f5_history_id": _with(
            """SELECT board_id, count(*) AS histories,
                CAST(sum(CASE WHEN (l_orderkey + i) % 61 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS kept
            FROM (SELECT *, unnest(range(1, l_linenumber + 1)) AS i FROM every_entry)
            GROUP BY board_id""",
            "every_entry",
        ),
        "f6_issue_id": _with(
            """SELECT board_id, issue_ref, count(*) AS entries FROM every_entry
            WHERE issue_ref <> '' GROUP BY board_id, issue_ref""",
            "every_entry",
        ),
        "p6_labels": _with(
            f"""SELECT board_id, {_LABELS} AS labels, count(*) AS entries FROM every_entry
            GROUP BY 1, 2""",
            "every_entry",
        ),
        "p7_custom_fields": _with(
            f"""SELECT l_orderkey AS id, c AS project_id, {_TYPE_OF_WORK} AS type_of_work,
                'Team "' || l_returnflag || '"' AS team,
                CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS story_points,
                {_SPRINTS} AS sprints,
                CASE WHEN l_linenumber % 2 = 0
                     THEN CASE WHEN l_partkey % 2 = 0 THEN 'true' ELSE 'false' END END AS flagged,
                CAST(NULL AS VARCHAR) AS nowhere FROM iss""",
            "iss",
        ),
        "p8_assignee_mask": _with(
            """SELECT transition_id, issue_id, from_id, from_string, to_id, to_string FROM tr
            WHERE transition_field = 'assignee'""",
            "tr",
        ),
        "p9_issue_project": _with(
            """SELECT l_orderkey AS id, 'P' || o_custkey || '-' || l_orderkey AS key,
            c AS project_id, project_key, project_name FROM iss""",
            "iss",
        ),
        "v_rejects_by_reason": _with(
            _REJECTS,
            "rl",
            "winner",
        ),
        "v_rejected_transitions": _with(
            """SELECT CAST(transition_id AS VARCHAR) AS entity_id, 'fieldtype is null' AS reason, transition_field AS field
            FROM tr WHERE transition_field_type = 'second'""",
            "tr",
        ),
        "v_rejected_issues": _with(
            """SELECT issue_ref AS entity_id, reason,
            'Order ' || l_orderkey || ' line ' || l_linenumber AS summary
            FROM winner WHERE reason IS NOT NULL""",
            "winner",
        ),
        "v_nulled_values": _with(
            """SELECT 'Type ' || l_linenumber AS issue_type,
                count(CASE WHEN l_linenumber = 7 THEN 1 END) AS issuetype_id,
                count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS status_category_id,
                count(CASE WHEN l_linenumber % 5 <> 0 THEN 1 END) AS parent_task_id,
                count(*) - count(created) AS created, count(*) - count(updated) AS updated
            FROM every_entry GROUP BY l_linenumber""",
            "every_entry",
        ),
        "j3_first_board_wins": _with(
            """SELECT c AS project_id, issue_ref, board_id, ord,
            'Order ' || l_orderkey || ' line ' || l_linenumber AS summary
            FROM winner WHERE issue_ref <> ''""",
            "winner",
        ),
        "l3_insert_if_absent": _with(
            f"""SELECT transition_id, issue_id, transition_field, project_id, from_string, to_id
            FROM ({_FIRST_LOADS}) n WHERE NOT EXISTS (
                SELECT 1 FROM lineitem t WHERE t.l_shipdate < TIMESTAMP '1998-06-01'
                  AND t.l_orderkey * 10 + t.l_linenumber = n.transition_id
                  AND t.l_orderkey = n.issue_id
                  AND ({_FIELDS})[t.l_linenumber] = n.transition_field)""",
            "tr",
        ),
        "a1_run_summary": _with(_RECORDS, "ids"),
        "a2_load_summary": _with(
            "SELECT data_type, n AS inserted, CAST(0 AS BIGINT) AS inserted_again FROM loaded",
            "loaded",
        ),
        "u3_align_columns": """SELECT c_custkey AS id, c_name AS name, c_mktsegment,
                CAST(NULL AS VARCHAR) AS p_type FROM customer
            UNION ALL SELECT s_suppkey, s_name, NULL, NULL FROM supplier
            UNION ALL SELECT p_partkey, NULL, NULL, p_type FROM part""",
        "s8_bulk_prefixes": _with(
            f"SELECT * FROM ({_RECORDS}) WHERE data_type IN ('projects', 'releases')", "ids"
        ),
        "k4_layout": _with(
            """SELECT data_type, run, count(*) AS records FROM (
                SELECT data_type, '20240601' AS run FROM ids
                WHERE data_type IN ('projects', 'boards')
                UNION ALL SELECT data_type, '20240602' FROM ids WHERE data_type = 'boards')
            GROUP BY data_type, run""",
            "ids",
        ),
        "k5_append_run": _with(
            """SELECT data_type, entity FROM ids WHERE data_type IN ('projects', 'boards')
            UNION ALL SELECT data_type, entity FROM ids WHERE data_type = 'boards'""",
            "ids",
        ),
        "k6_replace_run": _with(
            """SELECT 'projects' AS data_type, CAST(c AS VARCHAR) AS entity FROM ok_pj
            WHERE archived
            UNION ALL SELECT data_type, entity FROM ids WHERE data_type = 'boards'""",
            "ids",
        ),
        "k7_part_sizes": _with(
            """SELECT count(*) AS records, CAST(0 AS BIGINT) AS oversize FROM bd
            WHERE reason IS NULL""",
            "bd",
        ),
        "k8_typed_nulls": _with(
            """SELECT 'timestamp' AS release_date_type, 'string' AS project_key_type,
            'boolean' AS released_type, count(*) AS records,
            CAST(0 AS BIGINT) AS release_date_filled, CAST(0 AS BIGINT) AS project_key_filled,
            CAST(0 AS BIGINT) AS released_filled FROM rl WHERE reason IS NULL""",
            "rl",
        ),
        "k9_empty_custom": _with(
            "SELECT count(*) AS records, CAST(0 AS BIGINT) AS filled FROM iss", "iss"
        ),
        "k10_empty_type": _with(
            """SELECT t.data_type, t.data_type = 'projects' AS has_parts,
                count(CASE WHEN t.data_type = 'projects' THEN i.entity END) AS records
            FROM (SELECT unnest(['projects', 'releases', 'boards', 'issues', 'transitions'])
                      AS data_type) t LEFT JOIN ids i ON i.data_type = t.data_type
            GROUP BY t.data_type""",
            "ids",
        ),
        "r1_run": _with(
            f"""SELECT r.data_type, CAST(NULL AS VARCHAR) AS reason, records, n AS in_table
            FROM ({_RECORDS}) r JOIN loaded l ON l.data_type = r.data_type
            UNION ALL SELECT relation, reason, rejects, 0 FROM ({_REJECTS})""",
            "ids",
            "loaded",
            "rl",
            "winner",
        ),
        "l1_tables": _with(
            """SELECT l_orderkey AS id, project_id, 'Team "' || l_returnflag || '"' AS team,
                CAST(l_quantity AS BIGINT) AS story_points, 'bigint' AS id_type,
                'variant' AS custom_type
            FROM (SELECT *, c AS project_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY c)
                      AS place FROM iss) WHERE place = 1""",
            "iss",
        ),
        "l4_plain_insert": _with(
            """SELECT n AS board_id, board_name AS name, CAST(2 AS BIGINT) AS copies FROM bd
            WHERE reason IS NULL""",
            "bd",
        ),
        "l5_required_columns": _with(
            """SELECT missing_column, count(*) AS records FROM (
                SELECT CASE WHEN issue_ref = '' OR l_orderkey % 41 = 40 THEN 'id'
                            WHEN l_orderkey % 47 = 46 AND l_linenumber % 2 = 0 THEN 'key' END
                       AS missing_column FROM winner)
            WHERE missing_column IS NOT NULL GROUP BY missing_column""",
            "winner",
        ),
        "l6_bulk_load": _with(
            f"""SELECT data_type, 2 * records AS records, records AS inserted FROM ({_RECORDS})
            WHERE data_type IN ('issues', 'transitions')""",
            "ids",
        ),
        "x_hash_pii": """SELECT doc_id, sha256(text || chr(31) ||
            CASE WHEN doc_id % 3 <> 0 THEN source ELSE '' END) AS hashed FROM documents""",
        "x_safe_str": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0
            THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS text FROM orders""",
        "x_safe_int": """SELECT l_orderkey, l_linenumber, l_partkey,
            CASE (l_orderkey + l_linenumber) % 9 WHEN 0 THEN l_partkey WHEN 4 THEN -l_partkey
                 WHEN 6 THEN l_partkey END AS number FROM lineitem""",
        "x_safe_bool": f"""SELECT event_id,
            CASE WHEN lower(w) IN ('true', '1', 'yes') THEN true
                 WHEN lower(w) IN ('false', '0', 'no') THEN false END AS flag
            FROM (SELECT event_id, ({words})[event_id % 11 + 1] AS w FROM events)""",
        "x_clean_ws": r"""SELECT conv_id, turn, t AS text, 'a|' || trim(role, ws) || '|' || t
                AS joined
            FROM (SELECT *, trim(text, ws) AS t FROM (SELECT *, ' ' || chr(9) || chr(10)
                || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31)
                || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194)
                || chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(8199) || chr(8200)
                || chr(8201) || chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287)
                || chr(12288) AS ws FROM conversations))""",
        "x_release_date": """SELECT o_orderkey, CASE o_orderkey % 5
                WHEN 2 THEN epoch_us(CAST(d AS TIMESTAMP) + INTERVAL 425 MINUTE)
                WHEN 3 THEN NULL WHEN 4 THEN NULL
                ELSE epoch_us(CAST(d AS TIMESTAMP)) END AS date_us
            FROM (SELECT o_orderkey, DATE '1969-01-01' + CAST((o_orderkey * 37) % 36500 AS INTEGER)
                      AS d FROM orders)""",
        "x_iso_ts": """SELECT event_id, CASE event_id % 6 WHEN 0 THEN epoch_us(ts)
                WHEN 1 THEN epoch_us(ts) + 12600000000
                WHEN 2 THEN epoch_us(date_trunc('second', ts))
                WHEN 5 THEN epoch_us(date_trunc('millisecond', ts)) - 20700000000 END AS ts_us
            FROM events""",
        "x_first_truthy": """SELECT p_partkey,
            CASE WHEN p_partkey % 3 = 0 AND p_name <> '' THEN p_name
                 WHEN p_partkey % 5 <> 0 THEN p_brand END AS picked FROM part""",
        "x_to_json": """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN '{"kind":' ||
            CASE WHEN event_id % 3 <> 0 THEN '"' || event_type || '"' ELSE 'null' END ||
            ',"user":"' || user_id || '"}' END AS json FROM events""",
        "x_parse_json": """SELECT event_id, CASE WHEN event_id % 5 <> 0
            THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events""",
        "t1_stream_matches_batch": _with("SELECT data_type, entity FROM ids", "ids"),
        "t1_stream_issues": _with(_ISSUES, "iss"),
        "t2_stream_dedupe": _with("SELECT DISTINCT c AS project_id, issue_ref FROM entry", "entry"),
        "t3_replay": _with("SELECT data_type, n AS records FROM loaded", "loaded"),
    }
