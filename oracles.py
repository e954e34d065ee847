"""DuckDB oracle SQL for every checked query.

The oracle never shares the engine's code path: tree paths are written as
strings straight from the base tables (the fixture rules), so a wrong
traversal in the engine fails the comparison.
"""

from __future__ import annotations

# Fixture views shared by the oracle queries.
SUBMISSIONS = """
  SELECT CAST(o_orderkey AS VARCHAR) AS submission_id, o_orderpriority AS problem_id,
         CAST(o_custkey AS VARCHAR) AS user_id, 'cpp' AS language,
         CASE o_orderstatus WHEN 'F' THEN 'OK' WHEN 'O' THEN 'PT' ELSE 'P' END AS status
  FROM orders"""

PAIRS = f"""
  SELECT problem_id, user_id,
         min(CASE WHEN status = 'OK' THEN submission_id END) AS ok_id,
         min(CASE WHEN status = 'PT' THEN submission_id END) AS pt_id
  FROM ({SUBMISSIONS}) s
  WHERE status IN ('OK', 'PT')
  GROUP BY problem_id, user_id
  HAVING min(CASE WHEN status = 'OK' THEN submission_id END) IS NOT NULL
     AND min(CASE WHEN status = 'PT' THEN submission_id END) IS NOT NULL"""

# Lines of each order with their part and the order's line count.
LINES = """
  SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, p.p_brand, p.p_name, p.p_type, p.p_size, c.nl
  FROM lineitem l
  JOIN part p ON p.p_partkey = l.l_partkey
  JOIN (SELECT l_orderkey AS k, count(*) AS nl FROM lineitem GROUP BY l_orderkey) c ON c.k = l.l_orderkey"""

# Every leaf of every order tree with its compressed (forks + leaf) ids, the
# full root ids, the token and flags, written out by hand from the fixture.
LEAVES = f"""
  SELECT CAST(o.o_orderkey AS VARCHAR) AS doc_id, 'status' AS leaf_type, o.o_orderstatus AS leaf_value, 0 AS leaf_row,
         CASE WHEN c.nl IS NULL THEN '1200' ELSE '0011200' END AS fork_ids,
         '0011200' AS all_ids, 2 AS path_len, false AS is_extra, true AS is_named,
         CASE WHEN c.nl IS NULL THEN 1 ELSE 2 END AS fork_len, '' AS sub_ids, 0 AS sub_len, '1200001' AS rev_ids,
         CASE WHEN c.nl IS NULL THEN '1200' ELSE '1200001' END AS rev_fork_ids
  FROM orders o LEFT JOIN (SELECT l_orderkey AS k, count(*) AS nl FROM lineitem GROUP BY l_orderkey) c
       ON c.k = o.o_orderkey
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), 'brand', p_brand, l_linenumber,
         CASE WHEN nl >= 2 THEN '001002003004005' ELSE '001003004005' END,
         '001002003004005', 5, false, true, CASE WHEN nl >= 2 THEN 5 ELSE 4 END, '004005', 2,
         '005004003002001', CASE WHEN nl >= 2 THEN '005004003002001' ELSE '005004003001' END FROM ({LINES}) x
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), 'identifier', p_name, l_linenumber,
         CASE WHEN nl >= 2 THEN '001002003004006' ELSE '001003004006' END,
         '001002003004006', 5, false, true, CASE WHEN nl >= 2 THEN 5 ELSE 4 END, '004006', 2,
         '006004003002001', CASE WHEN nl >= 2 THEN '006004003002001' ELSE '006004003001' END FROM ({LINES}) x
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), 'comment', p_type, l_linenumber,
         CASE WHEN nl >= 2 THEN '001002003004008' ELSE '001003004008' END,
         '001002003004008', 5, true, true, CASE WHEN nl >= 2 THEN 5 ELSE 4 END, '004008', 2,
         '008004003002001', CASE WHEN nl >= 2 THEN '008004003002001' ELSE '008004003001' END FROM ({LINES}) x
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), 'number', CAST(p_size AS VARCHAR), l_linenumber,
         CASE WHEN nl >= 2 THEN '001002003004010' ELSE '001003004010' END,
         '001002003004009010', 6, false, true, CASE WHEN nl >= 2 THEN 5 ELSE 4 END, '004009010', 3,
         '010009004003002001', CASE WHEN nl >= 2 THEN '010004003002001' ELSE '010004003001' END FROM ({LINES}) x
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), 'flag', l_returnflag, l_linenumber,
         CASE WHEN nl >= 2 THEN '001002003007' ELSE '001003007' END,
         '001002003007', 4, false, false, CASE WHEN nl >= 2 THEN 4 ELSE 3 END, '', 0,
         '007003002001', CASE WHEN nl >= 2 THEN '007003002001' ELSE '007003001' END FROM ({LINES}) x"""

# Distinct paths to inner nodes; a single-child order has no line items, a single-child list one.
PATH_TRIE = """
  WITH o AS (SELECT coalesce(c.nl, 0) AS nl FROM orders LEFT JOIN
             (SELECT l_orderkey AS k, count(*) AS nl FROM lineitem GROUP BY l_orderkey) c ON c.k = o_orderkey),
  p AS (SELECT '001' AS path_ids, CASE WHEN nl = 0 THEN '' ELSE '001' END AS fork_ids, 1 AS path_len,
               CASE WHEN nl = 0 THEN 0 ELSE 1 END AS fork_len, '001' AS reversed_ids, 1 AS symbol, nl = 0 AS is_single, 1 AS w FROM o
        UNION ALL SELECT '001002', CASE WHEN nl = 1 THEN '001' ELSE '001002' END, 2, CASE WHEN nl = 1 THEN 1 ELSE 2 END,
               '002001', 2, nl = 1, 1 FROM o WHERE nl > 0
        UNION ALL SELECT '001002003', CASE WHEN nl = 1 THEN '001003' ELSE '001002003' END, 3, CASE WHEN nl = 1 THEN 2 ELSE 3 END,
               '003002001', 3, false, nl FROM o WHERE nl > 0
        UNION ALL SELECT '001002003004', CASE WHEN nl = 1 THEN '001003004' ELSE '001002003004' END, 4,
               CASE WHEN nl = 1 THEN 3 ELSE 4 END, '004003002001', 4, false, nl FROM o WHERE nl > 0
        UNION ALL SELECT '001002003004009', CASE WHEN nl = 1 THEN '001003004' ELSE '001002003004' END, 5,
               CASE WHEN nl = 1 THEN 3 ELSE 4 END, '009004003002001', 9, true, nl FROM o WHERE nl > 0)
  SELECT path_ids, fork_ids, path_len, fork_len, reversed_ids, symbol, is_single, sum(w)::BIGINT AS n_nodes, path_len = 1 AS is_root
  FROM p GROUP BY ALL"""

# Every subtree spelled out as text, then counted.
SUBTREES = """
  WITH r AS (SELECT l.l_orderkey AS k, p.p_brand AS b, p.p_name AS i, p.p_type AS c, CAST(p.p_size AS VARCHAR) AS s, l.l_returnflag AS f,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
               l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS r
             FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
  ref AS (SELECT k, r, f, s, concat_ws('|', b, i, c, s) AS ref FROM r),
  lists AS (SELECT k, string_agg(ref || '|' || f, '#' ORDER BY r) AS list, 5 * count(*) AS n FROM ref GROUP BY k),
  t AS (SELECT k, 9 AS symbol, 1 AS height, 1::BIGINT AS n_leaves, s AS txt FROM ref
        UNION ALL SELECT k, 4, 2, 4, ref FROM ref
        UNION ALL SELECT k, 3, 3, 5, ref || '|' || f FROM ref
        UNION ALL SELECT k, 2, 4, n, list FROM lists
        UNION ALL SELECT o_orderkey, 1, CASE WHEN n IS NULL THEN 1 ELSE 5 END, coalesce(n, 0) + 1, o_orderstatus || '#' || coalesce(list, '')
                  FROM orders LEFT JOIN lists ON k = o_orderkey)
  SELECT CAST(k AS VARCHAR) AS doc_id, symbol, height, n_leaves, count(*) OVER (PARTITION BY symbol, txt) AS n_equal FROM t"""

ERROR_LINES = f"""
WITH pairs AS ({PAIRS}),
leaves AS (SELECT doc_id, fork_ids || leaf_value AS signature, leaf_row FROM ({LEAVES}) lv),
pt AS (SELECT p.problem_id, p.user_id, p.ok_id, p.pt_id, lv.signature, lv.leaf_row AS line
       FROM pairs p JOIN leaves lv ON lv.doc_id = p.pt_id),
ok AS (SELECT p.problem_id, p.user_id, lv.signature
       FROM pairs p JOIN leaves lv ON lv.doc_id = p.ok_id)
SELECT DISTINCT problem_id, user_id, ok_id, pt_id, line FROM pt
WHERE NOT EXISTS (SELECT 1 FROM ok WHERE ok.problem_id = pt.problem_id AND ok.user_id = pt.user_id
                  AND ok.signature = pt.signature)"""


SOURCES = """
  SELECT CAST(doc_id AS VARCHAR) AS doc_id, source AS problem_id,
         CAST(doc_id % 700 AS VARCHAR) || '.' || lang AS file_name, lang AS ext, text
  FROM documents"""

COUNTS = f"SELECT problem_id, count(*) AS n_files FROM ({SOURCES}) s GROUP BY problem_id"

TOP = f"SELECT problem_id, n_files FROM ({COUNTS}) c ORDER BY n_files DESC, problem_id ASC LIMIT 10"

POOL = f"""
  SELECT doc_id, problem_id, file_name FROM (
    SELECT s.*, row_number() OVER (PARTITION BY s.file_name ORDER BY c.n_files ASC, s.problem_id DESC,
                                   s.doc_id DESC) AS rn
    FROM ({SOURCES}) s JOIN ({COUNTS}) c ON c.problem_id = s.problem_id) x
  WHERE rn = 1"""

TRAIN_VAL = f"""
  WITH pool AS ({POOL}),
  k AS (SELECT 75 * (count(*) // 100) AS k FROM ({SOURCES}) s),
  ranked AS (SELECT pool.*, row_number() OVER (ORDER BY md5('42:split:' || doc_id), doc_id) AS g FROM pool)
  SELECT r.doc_id, r.problem_id, r.file_name, CASE WHEN g <= (SELECT k FROM k) THEN 'train' ELSE 'val' END AS split,
         md5(s.text) AS text_md5
  FROM ranked r JOIN ({SOURCES}) s ON s.doc_id = r.doc_id"""

# Every node of every order tree (no ids: values only).
NODES = f"""
  SELECT CAST(o.o_orderkey AS VARCHAR) AS doc_id, 'order_unit' AS type, 0 AS start_row,
         false AS is_terminal, false AS is_named_terminal, c.nl IS NOT NULL AS is_fork
  FROM orders o LEFT JOIN (SELECT l_orderkey AS k, count(*) AS nl FROM lineitem GROUP BY l_orderkey) c
       ON c.k = o.o_orderkey
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'status', 0, true, true, false FROM orders
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'line_list', 0, false, false, count(*) >= 2
            FROM lineitem GROUP BY l_orderkey
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'line', l_linenumber, false, false, true FROM ({LINES}) x
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'part_ref', l_linenumber, false, false, true FROM ({LINES}) x
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'brand', l_linenumber, true, true, false FROM ({LINES}) x
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'identifier', l_linenumber, true, true, false FROM ({LINES}) x
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'comment', l_linenumber, true, false, false FROM ({LINES}) x
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'size_expr', l_linenumber, false, false, false FROM ({LINES}) x
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'number', l_linenumber, true, true, false FROM ({LINES}) x
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'flag', l_linenumber, true, false, false FROM ({LINES}) x"""

EDGES = """
  WITH r AS (SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_orderkey, l_partkey,
                    l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                    l_linestatus, l_shipdate) - 1 AS INTEGER) AS r FROM lineitem)
  SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 'order_unit' AS parent_type, 0 AS child_idx, 'status' AS child_type
  FROM orders
  UNION ALL SELECT DISTINCT CAST(l_orderkey AS VARCHAR), 'order_unit', 1, 'line_list' FROM lineitem
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'line_list', r, 'line' FROM r
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'line', 0, 'part_ref' FROM lineitem
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'line', 1, 'flag' FROM lineitem
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'part_ref', 0, 'brand' FROM lineitem
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'part_ref', 1, 'identifier' FROM lineitem
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'part_ref', 2, 'comment' FROM lineitem
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'part_ref', 3, 'size_expr' FROM lineitem
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'size_expr', 0, 'number' FROM lineitem"""

# Every node with its preorder id (line of rank r owns ids 3+8r .. 10+8r) and parent id.
NODE_IDS = """
  WITH c AS (SELECT l_orderkey AS k, count(*) AS nl FROM lineitem GROUP BY l_orderkey),
  r AS (SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_orderkey, l_partkey,
               l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
               l_linestatus, l_shipdate) - 1 AS INTEGER) AS r FROM lineitem),
  lines AS (SELECT l_orderkey, 3 + 8 * r AS b FROM r)
  SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 0 AS node_id, NULL AS parent_id, 'order_unit' AS type FROM orders
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 1, 0, 'status' FROM orders
  UNION ALL SELECT CAST(k AS VARCHAR), 2, 0, 'line_list' FROM c
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), b, 2, 'line' FROM lines
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), b + 1, b, 'part_ref' FROM lines
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), b + 2, b + 1, 'brand' FROM lines
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), b + 3, b + 1, 'identifier' FROM lines
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), b + 4, b + 1, 'comment' FROM lines
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), b + 5, b + 1, 'size_expr' FROM lines
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), b + 6, b + 5, 'number' FROM lines
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), b + 7, b, 'flag' FROM lines"""

# The pairs of terminals themselves, counted: in one part_ref, in one line, across lines, or with the order's status.
TERMINAL_CONTEXTS = """
  WITH r AS (SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_orderkey, l_partkey,
               l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
               l_linestatus, l_shipdate) - 1 AS INTEGER) AS r FROM lineitem),
  b AS (SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, 3 + 8 * r AS b FROM r),
  t AS (SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, NULL AS b, 1 AS id, 'status' AS type, false AS in_ref FROM orders
        UNION ALL SELECT doc_id, b, b + 2, 'brand', true FROM b
        UNION ALL SELECT doc_id, b, b + 3, 'identifier', true FROM b
        UNION ALL SELECT doc_id, b, b + 6, 'number', true FROM b
        UNION ALL SELECT doc_id, b, b + 7, 'flag', false FROM b),
  p AS (SELECT x.doc_id, least(x.type, y.type) AS type_a, greatest(x.type, y.type) AS type_b, x.id AS x, y.id AS y, x.type AS t,
               CASE WHEN x.b IS NULL THEN 0 WHEN x.b <> y.b THEN 2 WHEN x.in_ref AND y.in_ref THEN x.b + 1 ELSE x.b END AS lca_id,
               CASE WHEN x.b IS NULL THEN 'order_unit' WHEN x.b <> y.b THEN 'line_list'
                    WHEN x.in_ref AND y.in_ref THEN 'part_ref' ELSE 'line' END AS lca_type
        FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.id < y.id),
  g AS (SELECT doc_id, lca_id, lca_type, type_a, type_b, count(*) AS n_pairs, min({'x': x, 'y': y, 't': t}) AS f FROM p GROUP BY ALL)
  SELECT doc_id, lca_id, lca_type, type_a, type_b, n_pairs, CASE WHEN f.t = type_a THEN f.x ELSE f.y END AS leaf_a,
         CASE WHEN f.t = type_a THEN f.y ELSE f.x END AS leaf_b FROM g"""

# Accepted corpus terminals with their document-order id (see NODE_IDS).
CORPUS_DOC_ORDER = """
  WITH c AS (SELECT l_orderkey AS k, count(*) AS nl FROM lineitem GROUP BY l_orderkey),
  r AS (SELECT l.l_orderkey, l.l_linenumber, p.p_brand, p.p_size,
               CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_orderkey, l_partkey,
               l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
               l_linestatus, l_shipdate) - 1 AS INTEGER) AS r
        FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
  b AS (SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, 5 + 8 * r AS ord,
               '001002003004005_' || md5(p_brand) AS branch FROM r
        UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 6 + 8 * r, '001002003004006_' || md5('identifier') FROM r
        UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 9 + 8 * r,
               '001002003004009010_' || md5(CAST(p_size AS VARCHAR)) FROM r),
  per AS (SELECT doc_id, count(*) AS n, string_agg(branch, ' ' ORDER BY ord) AS bs FROM b GROUP BY doc_id)
  SELECT CAST(o.o_orderkey AS VARCHAR) AS doc_id, CAST(o.o_orderkey AS VARCHAR) AS stem,
         coalesce(per.n, 0) AS n_branches,
         CASE WHEN per.bs IS NULL THEN CAST(o.o_orderkey AS VARCHAR)
              ELSE CAST(o.o_orderkey AS VARCHAR) || ' ' || per.bs END AS line
  FROM orders o LEFT JOIN per ON per.doc_id = CAST(o.o_orderkey AS VARCHAR)"""

# The ranked OK x PT self-join itself, summarised per (problem, user).
CANDIDATES = f"""
  WITH s AS ({SUBMISSIONS}),
  j AS (SELECT a.problem_id, a.user_id, a.submission_id AS ok_id, b.submission_id AS pt_id,
               row_number() OVER (PARTITION BY a.problem_id, a.user_id
                                  ORDER BY a.submission_id, b.submission_id) AS pair_rank,
               count(*) OVER (PARTITION BY a.problem_id, a.user_id) AS n_candidates
        FROM s a JOIN s b ON a.user_id = b.user_id AND a.problem_id = b.problem_id
                         AND a.status = 'OK' AND b.status = 'PT'),
  k AS (SELECT problem_id, user_id, count(*) FILTER (WHERE status = 'OK') AS n_ok,
               count(*) FILTER (WHERE status = 'PT') AS n_pt FROM s GROUP BY problem_id, user_id)
  SELECT j.problem_id, j.user_id, k.n_ok, k.n_pt, j.n_candidates, j.ok_id, j.pt_id
  FROM j JOIN k ON k.problem_id = j.problem_id AND k.user_id = j.user_id WHERE j.pair_rank = 1"""

TREE_DOT = f"""
  WITH n AS ({NODE_IDS}),
  items AS (SELECT doc_id, 0 AS k, node_id, printf('  n%d [label="%s"];', node_id, type) AS s FROM n
            UNION ALL
            SELECT doc_id, 1, node_id, printf('  n%d -> n%d;', parent_id, node_id) FROM n WHERE parent_id IS NOT NULL)
  SELECT doc_id, 'digraph tree {{' || chr(10) || string_agg(s, chr(10) ORDER BY k, node_id, s) || chr(10) || '}}' || chr(10)
         AS dot
  FROM items GROUP BY doc_id"""

# Accepted corpus terminals: not extra, at least 5 nodes; token masked for identifiers.
BRANCHES = f"""
  SELECT doc_id, all_ids || '_' || md5(token) AS branch, md5(token) AS key, token FROM (
    SELECT doc_id, all_ids, CASE WHEN is_named AND leaf_type <> 'identifier' THEN leaf_value ELSE leaf_type END
           AS token
    FROM ({LEAVES}) lv WHERE NOT is_extra AND path_len >= 5) b"""

VOCAB = f"SELECT DISTINCT key, token, '[' || token || ']' AS display FROM ({BRANCHES}) b"

CLICK_PROBLEM = """CASE user_id % 5 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' WHEN 2 THEN '3-MEDIUM'
         WHEN 3 THEN '4-NOT SPECIFIED' ELSE '5-LOW' END"""

CLICKS = f"""
  SELECT {CLICK_PROBLEM} AS problem_id, CAST(user_id AS VARCHAR) AS user_id, CAST(trunc(value) AS INTEGER) AS line
  FROM events WHERE event_type = 'click'"""

REVIEWED = f"SELECT DISTINCT {CLICK_PROBLEM} AS problem_id, CAST(user_id AS VARCHAR) AS user_id FROM events"

TOGGLED = f"""
  SELECT problem_id, user_id, line FROM ({CLICKS}) c GROUP BY problem_id, user_id, line
  HAVING count(*) % 2 = 1"""

TEXT_LINES = """
  WITH s AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, string_split(text, chr(10)) AS parts
             FROM documents WHERE text IS NOT NULL AND text <> ''),
  t AS (SELECT doc_id, parts,
               CASE WHEN parts[len(parts)] = '' THEN len(parts) - 1 ELSE len(parts) END AS n FROM s),
  u AS (SELECT doc_id, parts, unnest(generate_series(1, n)) AS i FROM t)
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS line, parts[i] AS text FROM u"""

# Lines of every text, with byte offsets (a trailing newline opens an empty last line here).
FILE_LINES = """
  WITH p AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, string_split(text, chr(10)) AS parts FROM documents
             WHERE text IS NOT NULL),
  u AS (SELECT doc_id, parts[i] AS line, CAST(i - 1 AS INTEGER) AS r FROM (
          SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS i FROM p) g)
  SELECT doc_id, r, line, strlen(line) AS size,
         coalesce(sum(strlen(line) + 1) OVER (PARTITION BY doc_id ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING
                                              AND 1 PRECEDING), 0) AS start
  FROM u"""

# Listing of a tree: the terminal values of a row in document order.
LISTING = """
  WITH r AS (SELECT l.l_orderkey, l.l_linenumber, p.p_brand, p.p_name, p.p_type, p.p_size, l.l_returnflag,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
               l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS r
             FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey)
  SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, l_linenumber AS line,
         string_agg(p_brand || ' ' || p_name || ' ' || p_type || ' ' || CAST(p_size AS VARCHAR) || ' ' || l_returnflag, ' '
                    ORDER BY r) AS text
  FROM r GROUP BY l_orderkey, l_linenumber
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 0, o_orderstatus FROM orders"""

REVIEW_SHEET = f"""
  WITH pairs AS ({PAIRS}),
  el AS ({ERROR_LINES}),
  ls AS ({LISTING}),
  p AS (SELECT *, printf('%d / %d', row_number() OVER (PARTITION BY problem_id ORDER BY ok_id, pt_id),
                         count(*) OVER (PARTITION BY problem_id)) AS position FROM pairs),
  k AS (SELECT problem_id, user_id, line FROM p JOIN ls ON ls.doc_id = p.pt_id
        UNION SELECT problem_id, user_id, line FROM p JOIN ls ON ls.doc_id = p.ok_id
        UNION SELECT problem_id, user_id, line FROM el)
  SELECT p.problem_id, p.user_id, p.ok_id, p.pt_id, p.position, NULL AS statement, k.line + 1 AS line_no,
         printf('%5d  %s', k.line + 1, a.text) AS pt_listing, printf('%5d  %s', k.line + 1, b.text) AS ok_listing,
         e.line IS NOT NULL AS suspect
  FROM p JOIN k ON k.problem_id = p.problem_id AND k.user_id = p.user_id
  LEFT JOIN ls a ON a.doc_id = p.pt_id AND a.line = k.line
  LEFT JOIN ls b ON b.doc_id = p.ok_id AND b.line = k.line
  LEFT JOIN el e ON e.problem_id = p.problem_id AND e.user_id = p.user_id AND e.line = k.line
  UNION ALL
  SELECT p.problem_id, p.user_id, p.ok_id, p.pt_id, p.position, s.text, 0, NULL, NULL, false
  FROM p LEFT JOIN documents s ON s.doc_id BETWEEN 1 AND 5 AND CAST(s.doc_id AS VARCHAR) = substr(p.problem_id, 1, 1)"""

RESOLVED = f"""
      WITH pairs AS ({PAIRS}),
      el AS ({ERROR_LINES}),
      manual AS (SELECT t.problem_id, t.user_id, p.pt_id, t.line, 'manual' AS origin
                 FROM ({TOGGLED}) t JOIN pairs p ON p.problem_id = t.problem_id AND p.user_id = t.user_id),
      auto AS (SELECT e.problem_id, e.user_id, p.pt_id, e.line, 'auto' AS origin
               FROM el e JOIN pairs p ON p.problem_id = e.problem_id AND p.user_id = e.user_id
               WHERE NOT EXISTS (SELECT 1 FROM ({TOGGLED}) t
                                 WHERE t.problem_id = e.problem_id AND t.user_id = e.user_id))
      SELECT DISTINCT * FROM (SELECT * FROM manual UNION ALL SELECT * FROM auto) u"""

ORACLES: dict[str, str] = {
    "submissions_scan": SUBMISSIONS,
    "ok_pt_pairs": f"SELECT *, ok_id || '.cpp' AS ok_file, pt_id || '.cpp' AS pt_file FROM ({PAIRS}) p",
    "ok_pt_pairs_limited": f"""
      SELECT problem_id, user_id, ok_id, pt_id, ok_id || '.cpp' AS ok_file, pt_id || '.cpp' AS pt_file FROM (
        SELECT p.*, row_number() OVER (PARTITION BY problem_id ORDER BY ok_id, pt_id) AS rn FROM ({PAIRS}) p) x
      WHERE rn <= 100""",
    "other_solutions": f"""
      SELECT s.problem_id, s.user_id, s.submission_id, s.status FROM ({SUBMISSIONS}) s
      WHERE s.status <> 'OK' AND EXISTS (SELECT 1 FROM ({PAIRS}) p
                                         WHERE p.problem_id = s.problem_id AND p.user_id = s.user_id)""",
    "lookup_submission": f"""
      SELECT * FROM ({SUBMISSIONS}) s WHERE submission_id IN (SELECT pt_id FROM ({PAIRS}) p)""",
    "duplicate_keys": f"""
      SELECT user_id, count(*) AS n FROM ({SUBMISSIONS}) s GROUP BY user_id HAVING count(*) > 1""",
    "incomplete_rows": f"""
      SELECT submission_id, CASE WHEN problem_id = '4-NOT SPECIFIED' THEN '' ELSE problem_id END AS problem_id,
             user_id, language, status
      FROM ({SUBMISSIONS}) s
      WHERE coalesce(submission_id, '') = '' OR coalesce(problem_id, '') IN ('', '4-NOT SPECIFIED')
         OR coalesce(user_id, '') = '' OR coalesce(language, '') = '' OR coalesce(status, '') = ''""",
    "adhoc_sql": f"SELECT * FROM ({SUBMISSIONS}) s WHERE status = 'PT' AND problem_id = '1-URGENT'",
    # corpus selection
    "problem_counts": COUNTS,
    "top_problems": TOP,
    "top_problems_distinct": f"""
      SELECT problem_id, n_files FROM (SELECT n_files, min(problem_id) AS problem_id FROM ({COUNTS}) c
                                       GROUP BY n_files) d
      ORDER BY n_files DESC, problem_id ASC LIMIT 10""",
    "sample_per_problem": f"""
      SELECT doc_id, problem_id, file_name FROM (
        SELECT s.*, row_number() OVER (PARTITION BY problem_id ORDER BY md5('42:sample:' || doc_id), doc_id) AS rn
        FROM ({SOURCES}) s) x WHERE rn <= 30""",
    "flatten_corpus": POOL,
    "train_size": f"""
      SELECT count(*) AS n_total, 75 * (count(*) // 100) AS n_train FROM ({SOURCES}) s""",
    "train_val_split": TRAIN_VAL,
    "train_val_select": TRAIN_VAL,
    "growing_sample": f"""
      SELECT doc_id, problem_id, file_name, n_files FROM (
        SELECT s.*, row_number() OVER (PARTITION BY problem_id ORDER BY md5('42:sample:' || doc_id), doc_id) AS rn,
               count(*) OVER (PARTITION BY problem_id) AS n_files
        FROM ({SOURCES}) s) x WHERE rn <= 30""",
    "vocabulary_runs": f"""
      SELECT md5(token) AS key, token, CAST(max(run) AS INTEGER) AS run FROM (
        SELECT CASE WHEN is_named AND leaf_type <> 'identifier' THEN leaf_value ELSE leaf_type END AS token,
               CASE WHEN path_len >= 6 THEN 2 ELSE 1 END AS run
        FROM ({LEAVES}) lv WHERE NOT is_extra AND path_len >= 5) t
      GROUP BY token""",
    "point_lookup": f"SELECT * FROM ({SUBMISSIONS}) s WHERE submission_id = (SELECT max(submission_id) FROM ({SUBMISSIONS}) m)",
    # trees
    "root_paths": f"""
      SELECT doc_id, all_ids AS path_ids, path_len, leaf_type, leaf_value, leaf_row FROM ({LEAVES}) lv""",
    "path_trie": PATH_TRIE,
    "subtree_fingerprints": SUBTREES,
    "terminal_contexts": TERMINAL_CONTEXTS,
    "error_lines_unshared": ERROR_LINES,
    "sql_error_lines": ERROR_LINES,
    "sql_path_contexts": f"SELECT doc_id, branch FROM ({BRANCHES}) b",
    "sql_pairs": f"""
      SELECT p.problem_id, p.user_id, p.ok_id, p.pt_id, count(t.line) AS n_clicked
      FROM ({PAIRS}) p LEFT JOIN ({TOGGLED}) t ON t.problem_id = p.problem_id AND t.user_id = p.user_id GROUP BY ALL""",
    "fork_paths": f"""
      SELECT doc_id, fork_ids AS path_ids, fork_len AS path_len, leaf_type, leaf_value, leaf_row FROM ({LEAVES}) lv""",
    "reversed_paths": f"""
      SELECT doc_id, rev_ids AS path_ids, path_len, 'order_unit' AS leaf_type, leaf_value, leaf_row
      FROM ({LEAVES}) lv""",
    "subtree_paths": f"""
      SELECT doc_id, sub_ids AS path_ids, sub_len AS path_len, leaf_type, leaf_value, leaf_row
      FROM ({LEAVES}) lv WHERE sub_len > 0""",
    "reversed_fork_paths": f"""
      SELECT doc_id, rev_fork_ids AS path_ids, fork_len AS path_len, leaf_type, leaf_value, leaf_row FROM ({LEAVES}) lv""",
    "node_attributes": f"""
      SELECT doc_id, r + 1 AS node_id, 'line' AS type, 0 AS child_count, CAST(start AS INTEGER) AS start_byte,
             CAST(start + size AS INTEGER) AS end_byte, r AS start_row, 0 AS start_col, r AS end_row,
             CAST(size AS INTEGER) AS end_col FROM ({FILE_LINES}) f
      UNION ALL
      SELECT doc_id, 0, 'file', CAST(count(*) AS INTEGER), 0, CAST(max(start + size) AS INTEGER), 0, 0,
             CAST(count(*) - 1 AS INTEGER), CAST(arg_max(size, r) AS INTEGER) FROM ({FILE_LINES}) f GROUP BY doc_id""",
    "terminal_values": f"SELECT doc_id, r + 1 AS node_id, 'line' AS type, line AS text FROM ({FILE_LINES}) f",
    "node_equality": f"SELECT doc_id, child_type, child_idx, child_idx = 0 AS is_first_child FROM ({EDGES}) e",
    "file_stem": f"SELECT doc_id, file_name, regexp_replace(file_name, '\\.[^.]*$', '') AS stem FROM ({SOURCES}) s",
    "read_metadata": SUBMISSIONS,
    "vocabulary_file": f"SELECT key, display FROM ({VOCAB}) v",
    "node_predicates": NODES,
    "node_children": f"SELECT * FROM ({EDGES}) e WHERE child_idx = 1",
    "tree_edges": EDGES,
    "tree_dot": TREE_DOT,
    "extract_contexts": CORPUS_DOC_ORDER,
    "ok_pt_candidates": CANDIDATES,
    # path-contexts
    "branches": f"SELECT doc_id, branch FROM ({BRANCHES}) b",
    "doc_vocab": f"SELECT DISTINCT doc_id, key, token FROM ({BRANCHES}) b",
    "vocabulary": VOCAB,
    "vocabulary_size": f"SELECT count(*) AS n_entries FROM ({VOCAB}) v",
    "corpus_lines": f"""
      WITH per AS (SELECT doc_id, count(*) AS n, string_agg(branch, ' ' ORDER BY branch) AS bs
                   FROM ({BRANCHES}) b GROUP BY doc_id)
      SELECT CAST(o.o_orderkey AS VARCHAR) AS doc_id, CAST(o.o_orderkey AS VARCHAR) AS stem,
             coalesce(per.n, 0) AS n_branches,
             CASE WHEN per.bs IS NULL THEN CAST(o.o_orderkey AS VARCHAR)
                  ELSE CAST(o.o_orderkey AS VARCHAR) || ' ' || per.bs END AS line
      FROM orders o LEFT JOIN per ON per.doc_id = CAST(o.o_orderkey AS VARCHAR)""",
    "run_corpus": f"""
      WITH per AS (SELECT doc_id, string_agg(branch, ' ' ORDER BY branch) AS bs FROM ({BRANCHES}) b GROUP BY doc_id)
      SELECT CAST(o.o_orderkey AS VARCHAR) AS doc_id, CAST(o.o_orderkey AS VARCHAR) || coalesce(' ' || per.bs, '') AS line,
             'root_terminal|masked_identifiers|ids_hash' AS run
      FROM orders o LEFT JOIN per ON per.doc_id = CAST(o.o_orderkey AS VARCHAR)""",
    "run_files": f"""
      WITH per AS (SELECT doc_id, string_agg(branch, ' ' ORDER BY branch) AS bs FROM ({BRANCHES}) b GROUP BY doc_id)
      SELECT 'root_terminal|masked_identifiers|ids_hash_tokens.txt' AS file,
             CAST(o.o_orderkey AS VARCHAR) || coalesce(' ' || per.bs, '') AS record
      FROM orders o LEFT JOIN per ON per.doc_id = CAST(o.o_orderkey AS VARCHAR)
      UNION ALL SELECT 'root_terminal|masked_identifiers|ids_hash_mapping.txt', CAST(count(*) AS VARCHAR) FROM ({VOCAB}) v
      UNION ALL SELECT 'root_terminal|masked_identifiers|ids_hash_mapping.txt', key || ' ' || display FROM ({VOCAB}) v""",
    "corpus_source": """
      SELECT source AS problem_id, CAST(doc_id AS VARCHAR) || '.' || lang AS file_name, CAST(doc_id AS VARCHAR) AS stem, lang AS ext,
             md5(coalesce(text, '')) AS text_md5, strlen(coalesce(text, ''))::BIGINT AS n_bytes
      FROM documents""",
    "signature_groups": f"""
      SELECT doc_id, fork_ids || leaf_value AS signature, count(*) AS n_leaves, min(leaf_row) AS first_row
      FROM ({LEAVES}) lv GROUP BY doc_id, fork_ids || leaf_value""",
    # diff and labels
    "error_lines": ERROR_LINES,
    "label_lines": f"""
      WITH el AS ({ERROR_LINES}),
      per AS (SELECT problem_id, user_id, count(*) AS n, string_agg(CAST(line AS VARCHAR), ' ' ORDER BY line) AS ls
              FROM el GROUP BY problem_id, user_id)
      SELECT p.problem_id, p.user_id, p.pt_id || '.cpp' AS pt_file, CAST(coalesce(per.n, 0) AS INTEGER) AS n_lines,
             CASE WHEN per.ls IS NULL THEN p.pt_id || '.cpp' ELSE p.pt_id || '.cpp ' || per.ls END AS label_line
      FROM ({PAIRS}) p LEFT JOIN per ON per.problem_id = p.problem_id AND per.user_id = p.user_id""",
    "toggled_lines": TOGGLED,
    "resolved_labels": RESOLVED,
    "reviewed_label_lines": f"""
      WITH lb AS ({RESOLVED}),
      per AS (SELECT problem_id, user_id, count(*) AS n, string_agg(CAST(line AS VARCHAR), ' ' ORDER BY line) AS ls
              FROM lb GROUP BY problem_id, user_id)
      SELECT p.problem_id, p.user_id, p.pt_id || '.cpp' AS pt_file, CAST(coalesce(per.n, 0) AS INTEGER) AS n_lines,
             CASE WHEN per.ls IS NULL THEN p.pt_id || '.cpp' ELSE p.pt_id || '.cpp ' || per.ls END AS label_line
      FROM ({PAIRS}) p JOIN ({REVIEWED}) r ON r.problem_id = p.problem_id AND r.user_id = p.user_id
      LEFT JOIN per ON per.problem_id = p.problem_id AND per.user_id = p.user_id""",
    "review_sheet": REVIEW_SHEET,
    "text_lines": TEXT_LINES,
    "numbered_lines": f"""
      SELECT doc_id, line + 1 AS line_no, printf('%5d  %s', line + 1, text) AS listing FROM ({TEXT_LINES}) t""",
}
