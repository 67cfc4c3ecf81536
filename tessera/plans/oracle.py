"""Equivalent SQL (DuckDB dialect) of every named query in ``catalog``.

The base tables are views named after the parquet files.  Derived inputs are
shared CTE fragments below; iterative operators are written out as one CTE per
round.  Floats are rounded exactly as on the Spark side.
"""

from __future__ import annotations

import math

from tessera.functions.expr import WHITESPACE_RE2

ORACLE = {}


def sql(name):
    def deco(fn):
        ORACLE[name] = fn()
        return fn
    return deco


# ---------------------------------------------------------------- fragments
TOKENS = f"""
tokens AS (
  SELECT doc_id, lang, term FROM (
    SELECT doc_id, lang,
           regexp_replace(w, '[^\\p{{L}}]', '', 'g') AS term
    FROM (SELECT doc_id, lang,
                 unnest(regexp_split_to_array(lower(text), '{WHITESPACE_RE2}')) AS w
          FROM documents)
  ) WHERE term <> ''
)"""

CORPUS_TFIDF = TOKENS + """,
tf AS (SELECT term, count(*)::BIGINT AS tf FROM tokens GROUP BY term),
idf AS (
  SELECT term, ln((SELECT count(*) FROM documents)::DOUBLE / count(DISTINCT doc_id)) AS idf
  FROM tokens GROUP BY term),
tfidf AS (SELECT term, tf, tf * idf AS tfidf FROM tf JOIN idf USING (term))"""


# ====================================================================== text
@sql("text_tokens")
def _():
    return f"WITH {TOKENS} SELECT doc_id, term FROM tokens"


@sql("term_frequency")
def _():
    return f"WITH {TOKENS} SELECT term, count(*)::BIGINT AS tf FROM tokens GROUP BY term"


@sql("doc_term_frequency")
def _():
    return (f"WITH {TOKENS} SELECT doc_id, term, count(*)::BIGINT AS tf "
            f"FROM tokens GROUP BY doc_id, term")


@sql("inverse_document_frequency")
def _():
    return f"WITH {CORPUS_TFIDF} SELECT term, round(idf, 6) AS idf FROM idf"


@sql("tfidf")
def _():
    return f"WITH {CORPUS_TFIDF} SELECT term, tf, round(tfidf, 6) AS tfidf FROM tfidf"


@sql("top_terms_tf")
def _():
    return (f"WITH {TOKENS} SELECT term, count(*)::BIGINT AS tf FROM tokens "
            f"GROUP BY term ORDER BY tf DESC, term ASC LIMIT 20")


@sql("top_terms_tfidf")
def _():
    return (f"WITH {CORPUS_TFIDF} SELECT term, round(tfidf, 6) AS tfidf FROM tfidf "
            f"ORDER BY round(tfidf, 6) DESC, term ASC LIMIT 20")


@sql("cosine_similarity")
def _():
    return f"""WITH {CORPUS_TFIDF},
lang_tf AS (SELECT lang, term, count(*) AS tf FROM tokens GROUP BY lang, term),
a AS (SELECT lang, term, tf * idf AS val FROM lang_tf JOIN idf USING (term)),
b AS (SELECT term, tfidf AS val FROM tfidf),
dot AS (SELECT a.lang, sum(a.val * b.val) AS dot FROM a JOIN b USING (term) GROUP BY a.lang),
na AS (SELECT lang, sum(val * val) AS na FROM a GROUP BY lang),
nb AS (SELECT sum(val * val) AS nb FROM b)
SELECT na.lang,
       round(CASE WHEN na.na * nb.nb = 0 THEN NULL
                  ELSE coalesce(dot.dot, 0) / sqrt(na.na * nb.nb) END, 6) AS cosine
FROM na LEFT JOIN dot USING (lang) CROSS JOIN nb"""


@sql("scores_roundtrip")
def _():
    return f"WITH {CORPUS_TFIDF} SELECT term, round(tfidf, 6) AS val FROM tfidf"


# ===================================================================== graph
SUPPLY_EDGES = """
supply_edges AS (
  SELECT DISTINCT src, dst FROM (
    SELECT 'C' || o.o_custkey::VARCHAR AS src, 'P' || l.l_partkey::VARCHAR AS dst
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    UNION ALL
    SELECT 'P' || l_partkey::VARCHAR, 'S' || l_suppkey::VARCHAR FROM lineitem
    UNION ALL
    SELECT 'S' || l_suppkey::VARCHAR, 'P' || l_partkey::VARCHAR FROM lineitem
      WHERE l_returnflag = 'R' AND l_suppkey % 2 = 0))"""

NATION_EDGES = """
nation_edges AS (
  SELECT c.c_nationkey AS src, s.s_nationkey AS dst
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

LINK_EDGES = """
link_edges AS (
  SELECT page_id::VARCHAR AS src,
         unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS dst
  FROM pages)"""

PART_SUPPLIER = """
part_supplier AS (
  SELECT DISTINCT 'P' || l_partkey::VARCHAR AS src, 'S' || l_suppkey::VARCHAR AS dst
  FROM lineitem)"""

PLACE_TREE = """
place_tree AS (
  SELECT 'C' || c_custkey::VARCHAR AS src, 'N' || c_nationkey::VARCHAR AS dst FROM customer
  UNION ALL
  SELECT 'N' || n_nationkey::VARCHAR, 'R' || n_regionkey::VARCHAR FROM nation)"""


def relabel_sql(name, of):
    return f"{name} AS (SELECT 'X' || md5(src) AS src, 'X' || md5(dst) AS dst FROM {of})"


def drop_one_edge_sql(name, of):
    return (f"{name} AS (SELECT src, dst FROM {of} WHERE md5(src || '|' || dst) <> "
            f"(SELECT min(md5(src || '|' || dst)) FROM {of}))")


def _f(x):
    return f"CAST({float(x)!r} AS DOUBLE)"


def pagerank_sql(edges, mode, gamma=0.15, max_iter=50, eps=0.01, p="pr"):
    """CTEs computing PageRank over CTE ``edges``; final table ``{p}_out(node, score)``."""
    ctes = [
        f"{p}_mult AS (SELECT src, dst, count(*) AS mult FROM {edges} GROUP BY src, dst)",
        f"{p}_adj AS MATERIALIZED (SELECT m.src, m.dst, m.mult, d.deg FROM {p}_mult m "
        f"JOIN (SELECT src, sum(mult) AS deg FROM {p}_mult GROUP BY src) d USING (src))",
        f"{p}_nodes AS MATERIALIZED (SELECT src AS node FROM {edges} UNION "
        f"SELECT dst FROM {edges})",
        f"{p}_n AS (SELECT count(*)::DOUBLE AS n FROM {p}_nodes)",
        f"{p}_s0 AS MATERIALIZED (SELECT node, 1.0::DOUBLE / (SELECT n FROM {p}_n) AS score "
        f"FROM {p}_nodes)",
    ]
    base = f"({_f(gamma)} / (SELECT n FROM {p}_n))"
    damp = _f(1.0 - gamma)
    for i in range(1, max_iter + 1):
        contrib = (f"SELECT m.dst AS node, sum(s.score * m.mult / m.deg) AS c "
                   f"FROM {p}_adj m JOIN {p}_s{i-1} s ON m.src = s.node GROUP BY m.dst")
        if mode == "standard":
            body = (f"SELECT q.node, {damp} * coalesce(c.c, 0) + {base} AS score "
                    f"FROM {p}_nodes q LEFT JOIN ({contrib}) c USING (node)")
        else:
            body = f"SELECT node, {damp} * c + {base} AS score FROM ({contrib})"
        ctes.append(f"{p}_s{i} AS MATERIALIZED ({body})")
        ctes.append(f"{p}_e{i} AS (SELECT {i} AS i, coalesce(sum(abs(a.score - b.score)), 0) "
                    f"AS err FROM {p}_s{i-1} a JOIN {p}_s{i} b USING (node))")
    errs = " UNION ALL ".join(f"SELECT * FROM {p}_e{i}" for i in range(1, max_iter + 1))
    ctes.append(f"{p}_stop AS (SELECT coalesce(min(i), {max_iter}) AS i FROM ({errs}) "
                f"WHERE err <= {_f(eps)})")
    allr = " UNION ALL ".join(f"SELECT {i} AS i, node, score FROM {p}_s{i}"
                              for i in range(1, max_iter + 1))
    ctes.append(f"{p}_pick AS (SELECT node, score FROM ({allr}) "
                f"WHERE i = (SELECT i FROM {p}_stop))")
    if mode == "standard":
        ctes.append(f"{p}_out AS (SELECT node, score FROM {p}_pick)")
    else:
        ctes.append(f"{p}_out AS (SELECT node, score FROM {p}_pick UNION ALL "
                    f"SELECT node, {base} AS score FROM {p}_nodes "
                    f"WHERE node NOT IN (SELECT node FROM {p}_pick))")
    return ",\n".join(ctes)


def wl_sql(edges, max_iter=20, p="wl"):
    """CTEs of WL colouring over CTE ``edges``; final table ``{p}_out(node, color)``."""
    ctes = [
        f"{p}_sym AS (SELECT src, dst FROM {edges} UNION ALL SELECT dst, src FROM {edges})",
        f"{p}_adj AS MATERIALIZED (SELECT src, dst, count(*) AS mult FROM {p}_sym "
        f"GROUP BY src, dst)",
        f"{p}_c0 AS MATERIALIZED (SELECT DISTINCT src AS node, '1' AS color FROM {p}_sym)",
    ]
    for i in range(1, max_iter + 1):
        ctes.append(
            f"{p}_c{i} AS MATERIALIZED (SELECT a.dst AS node, md5("
            f"sum(c.h1 * a.mult)::VARCHAR || '.' || sum(c.h2 * a.mult)::VARCHAR || '.' || "
            f"sum(a.mult)::VARCHAR) AS color FROM {p}_adj a JOIN ("
            f"SELECT node, ('0x' || substr(md5(color), 1, 13))::BIGINT::HUGEINT AS h1, "
            f"('0x' || substr(md5(color), 14, 13))::BIGINT::HUGEINT AS h2 FROM {p}_c{i-1}) c "
            f"ON a.src = c.node GROUP BY a.dst)")
    ks = " UNION ALL ".join([f"SELECT 0 AS i, 1 AS k"] + [
        f"SELECT {i} AS i, count(DISTINCT color) AS k FROM {p}_c{i}"
        for i in range(1, max_iter + 1)])
    ctes.append(f"{p}_k AS MATERIALIZED ({ks})")
    ctes.append(f"{p}_stop AS (SELECT coalesce(min(b.i), {max_iter}) AS i FROM {p}_k a "
                f"JOIN {p}_k b ON b.i = a.i + 1 WHERE a.k = b.k)")
    allr = " UNION ALL ".join(f"SELECT {i} AS i, node, color FROM {p}_c{i}"
                              for i in range(1, max_iter + 1))
    ctes.append(f"{p}_out AS (SELECT node, color FROM ({allr}) "
                f"WHERE i = (SELECT i FROM {p}_stop))")
    return ",\n".join(ctes)


def iso_sql(c1, c2):
    return f"""SELECT n_nodes_1, n_nodes_2, n_colors_1, n_colors_2, mismatched_colors,
  CASE WHEN n_nodes_1 <> n_nodes_2 OR mismatched_colors > 0 THEN 'not isomorphic'
       WHEN n_colors_1 = n_nodes_1 THEN 'isomorphic' ELSE 'maybe isomorphic' END AS verdict
FROM (
  SELECT coalesce(sum(h1.c1), 0)::BIGINT AS n_nodes_1, coalesce(sum(h2.c2), 0)::BIGINT AS n_nodes_2,
         count(h1.c1)::BIGINT AS n_colors_1, count(h2.c2)::BIGINT AS n_colors_2,
         sum(CASE WHEN coalesce(h1.c1, 0) <> coalesce(h2.c2, 0) THEN 1 ELSE 0 END)::BIGINT
           AS mismatched_colors
  FROM (SELECT color, count(*) AS c1 FROM {c1} GROUP BY color) h1
  FULL OUTER JOIN (SELECT color, count(*) AS c2 FROM {c2} GROUP BY color) h2 USING (color))"""


@sql("graph_out_edges")
def _():
    return (f"WITH {LINK_EDGES} SELECT e.src, e.dst, d.out_degree FROM link_edges e "
            f"JOIN (SELECT src, count(*)::BIGINT AS out_degree FROM link_edges GROUP BY src) d "
            f"USING (src)")


@sql("graph_nodes")
def _():
    return f"WITH {SUPPLY_EDGES} SELECT src AS node FROM supply_edges UNION SELECT dst FROM supply_edges"


@sql("graph_degree")
def _():
    return (f"WITH {PART_SUPPLIER} SELECT node, count(*)::BIGINT AS degree FROM ("
            f"SELECT src AS node FROM part_supplier UNION ALL SELECT dst FROM part_supplier) "
            f"GROUP BY node")


def _pr(edges_cte, edges, mode):
    return (f"WITH {edges_cte},\n{pagerank_sql(edges, mode)}\n"
            f"SELECT node, round(score, 9) AS score FROM pr_out")


@sql("pagerank")
def _():
    return _pr(SUPPLY_EDGES, "supply_edges", "standard")


@sql("pagerank_reference")
def _():
    return _pr(SUPPLY_EDGES, "supply_edges", "reference")


@sql("pagerank_links")
def _():
    return _pr(LINK_EDGES, "link_edges", "standard")


@sql("pagerank_nations")
def _():
    return _pr(NATION_EDGES, "nation_edges", "reference")


@sql("wl_coloring")
def _():
    return f"WITH {PLACE_TREE},\n{wl_sql('place_tree')}\nSELECT node, color FROM wl_out"


@sql("wl_coloring_part_supplier")
def _():
    return f"WITH {PART_SUPPLIER},\n{wl_sql('part_supplier')}\nSELECT node, color FROM wl_out"


@sql("color_classes")
def _():
    return f"""WITH {PART_SUPPLIER}, {relabel_sql('g2', 'part_supplier')},
{wl_sql('part_supplier', p='wa')},
{wl_sql('g2', p='wb')},
shared AS (SELECT DISTINCT color FROM wa_out INTERSECT SELECT DISTINCT color FROM wb_out)
SELECT color, 1 AS side, node FROM wa_out JOIN shared USING (color)
UNION ALL SELECT color, 2 AS side, node FROM wb_out JOIN shared USING (color)"""


@sql("isomorphism_relabelled")
def _():
    return f"""WITH {PART_SUPPLIER}, {relabel_sql('g2', 'part_supplier')},
{wl_sql('part_supplier', p='wa')},
{wl_sql('g2', p='wb')}
{iso_sql('wa_out', 'wb_out')}"""


@sql("isomorphism_edge_removed")
def _():
    return f"""WITH {PART_SUPPLIER}, {drop_one_edge_sql('g1', 'part_supplier')},
{relabel_sql('g2', 'g1')},
{wl_sql('part_supplier', p='wa')},
{wl_sql('g2', p='wb')}
{iso_sql('wa_out', 'wb_out')}"""


@sql("isomorphism_tree")
def _():
    return f"""WITH {PLACE_TREE}, {relabel_sql('g2', 'place_tree')},
{wl_sql('place_tree', p='wa')},
{wl_sql('g2', p='wb')}
{iso_sql('wa_out', 'wb_out')}"""


# ============================================================ recommenders
RATINGS = """
ratings AS (
  SELECT o.o_custkey AS "user", l.l_partkey AS item, avg(l.l_quantity) AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, l.l_partkey)"""

SPLIT = RATINGS + """,
split AS (
  SELECT "user", item, rating,
         ('0x' || substr(md5("user"::VARCHAR || '|' || item::VARCHAR), 1, 8))::BIGINT % 4 AS fold
  FROM ratings),
train AS (SELECT "user", item, rating FROM split WHERE fold <> 0),
test AS (SELECT "user", item, rating FROM split WHERE fold = 0)"""


def cooc_sql(group, member, a, b):
    return f"""
gm_{a} AS (SELECT DISTINCT {group} AS g, {member} AS m FROM train),
half_{a} AS (SELECT x.m AS {a}, y.m AS {b}, count(*)::BIGINT AS co
  FROM gm_{a} x JOIN gm_{a} y ON x.g = y.g AND x.m < y.m GROUP BY 1, 2),
co_{a} AS (SELECT {a}, {b}, co FROM half_{a} UNION ALL SELECT {b} AS {a}, {a} AS {b}, co FROM half_{a})"""


ITEM_SIM = SPLIT + "," + cooc_sql('"user"', "item", "i", "j") + """,
pop AS (SELECT item, count(*)::BIGINT AS n FROM train GROUP BY item),
sim_i AS (SELECT c.i, c.j, c.co / sqrt(p1.n * p2.n) AS sim
  FROM co_i c JOIN pop p1 ON c.i = p1.item JOIN pop p2 ON c.j = p2.item)"""

USER_SIM = SPLIT + "," + cooc_sql("item", '"user"', "u", "v") + """,
ucount AS (SELECT "user", count(*)::BIGINT AS n FROM train GROUP BY "user"),
sim_u AS (SELECT c.u, c.v, c.co / sqrt(p1.n * p2.n) AS sim
  FROM co_u c JOIN ucount p1 ON c.u = p1."user" JOIN ucount p2 ON c.v = p2."user")"""


def item_recs_sql(k=40, n=10):
    return ITEM_SIM + f""",
nb_i AS (SELECT i, j, sim FROM (SELECT i, j, sim, row_number() OVER (
  PARTITION BY i ORDER BY round(sim, 9) DESC, j ASC) AS nrank FROM sim_i) WHERE nrank <= {k}),
cand AS (SELECT t."user", nb.j AS item, nb.sim * t.rating AS s
  FROM train t JOIN nb_i nb ON t.item = nb.i),
cand2 AS (SELECT * FROM cand c WHERE NOT EXISTS (
  SELECT 1 FROM train t WHERE t."user" = c."user" AND t.item = c.item)),
scored AS (SELECT "user", item, sum(s) AS score FROM cand2 GROUP BY "user", item),
recs AS (SELECT "user", item, score, rank FROM (SELECT *, row_number() OVER (
  PARTITION BY "user" ORDER BY round(score, 6) DESC, item ASC)::INTEGER AS rank FROM scored)
  WHERE rank <= {n})"""


def user_recs_sql(k=20, n=10):
    return USER_SIM + f""",
nb_u AS (SELECT u, v, sim FROM (SELECT u, v, sim, row_number() OVER (
  PARTITION BY u ORDER BY round(sim, 9) DESC, v ASC) AS nrank FROM sim_u) WHERE nrank <= {k}),
hist AS (SELECT DISTINCT "user" AS v, item FROM train),
cand AS (SELECT nb.u AS "user", h.item, nb.sim FROM nb_u nb JOIN hist h ON nb.v = h.v),
cand2 AS (SELECT * FROM cand c WHERE NOT EXISTS (
  SELECT 1 FROM train t WHERE t."user" = c."user" AND t.item = c.item)),
scored AS (SELECT "user", item, sum(sim) AS score FROM cand2 GROUP BY "user", item),
recs AS (SELECT "user", item, score, rank FROM (SELECT *, row_number() OVER (
  PARTITION BY "user" ORDER BY round(score, 6) DESC, item ASC)::INTEGER AS rank FROM scored)
  WHERE rank <= {n})"""


HITS = """,
users AS (SELECT DISTINCT "user" FROM train),
test_items AS (SELECT DISTINCT "user", item FROM test),
hits AS (
  SELECT u."user", coalesce(h.hits, 0)::BIGINT AS hits, 10::BIGINT AS rec_count,
         coalesce(tc.test_count, 0)::BIGINT AS test_count
  FROM users u
  LEFT JOIN (SELECT r."user", count(*) AS hits FROM recs r JOIN test_items t
             ON r."user" = t."user" AND r.item = t.item GROUP BY r."user") h ON u."user" = h."user"
  LEFT JOIN (SELECT "user", count(*) AS test_count FROM test_items GROUP BY "user") tc
    ON u."user" = tc."user")"""

PR = """
SELECT sum(hits)::BIGINT AS hits, sum(rec_count)::BIGINT AS rec_count,
       sum(test_count)::BIGINT AS test_count,
       round(sum(hits)::DOUBLE / sum(rec_count), 6) AS precision,
       round(sum(hits)::DOUBLE / sum(test_count), 6) AS recall
FROM hits"""

COVERAGE = """
SELECT (SELECT count(DISTINCT item) FROM recs)::BIGINT AS rec_items,
       (SELECT count(DISTINCT item) FROM train)::BIGINT AS train_items,
       round((SELECT count(DISTINCT item) FROM recs)::DOUBLE /
             (SELECT count(DISTINCT item) FROM train), 6) AS coverage"""

POPULARITY = """
SELECT round(coalesce(s.pop_sum, 0), 6) AS pop_sum, (u.n * 10)::BIGINT AS rec_count,
       round(coalesce(s.pop_sum, 0) / (u.n * 10), 6) AS popularity
FROM (SELECT sum(ln(1 + p.n)) AS pop_sum FROM recs r JOIN
        (SELECT item, count(*) AS n FROM train GROUP BY item) p USING (item)) s,
     (SELECT count(DISTINCT "user") AS n FROM train) u"""


@sql("read_interactions")
def _():
    return f'WITH {RATINGS} SELECT "user", item, round(rating, 6) AS rating FROM ratings'


@sql("train_test_split")
def _():
    return (f"WITH {SPLIT} SELECT \"user\", item, 'train' AS part FROM train "
            f"UNION ALL SELECT \"user\", item, 'test' AS part FROM test")


@sql("item_popularity")
def _():
    return f"WITH {SPLIT} SELECT item, count(*)::BIGINT AS popularity FROM train GROUP BY item"


@sql("item_cooccurrence")
def _():
    return f"WITH {SPLIT}, {cooc_sql(chr(34) + 'user' + chr(34), 'item', 'i', 'j')} SELECT i, j, co FROM co_i"


@sql("item_similarity")
def _():
    return f"WITH {ITEM_SIM} SELECT i, j, round(sim, 6) AS sim FROM sim_i"


@sql("item_similarity_lines")
def _():
    return """WITH have AS (
  SELECT DISTINCT o.o_custkey AS u, l.l_partkey AS m FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
n AS (SELECT m, count(*) AS n FROM have GROUP BY m),
co AS (SELECT x.m AS i, y.m AS j, count(*) AS co FROM have x JOIN have y ON x.u = y.u AND x.m <> y.m GROUP BY 1, 2)
SELECT i, j, round(co / sqrt(a.n * b.n), 6) AS sim FROM co JOIN n a ON a.m = i JOIN n b ON b.m = j"""


@sql("item_cf_recommend")
def _():
    return f'WITH {item_recs_sql()} SELECT "user", item, round(score, 6) AS score, rank FROM recs'


@sql("item_cf_hits")
def _():
    return f'WITH {item_recs_sql()}{HITS} SELECT "user", hits, rec_count, test_count FROM hits'


@sql("item_cf_precision_recall")
def _():
    return f"WITH {item_recs_sql()}{HITS} {PR}"


@sql("item_cf_coverage")
def _():
    return f"WITH {item_recs_sql()} {COVERAGE}"


@sql("item_cf_popularity")
def _():
    return f"WITH {item_recs_sql()} {POPULARITY}"


#: The lists per rating, merged per user; follows ITEM_SIM.
PER_RATING = """nb_i AS (SELECT i, j, sim FROM (SELECT i, j, sim, row_number() OVER (
  PARTITION BY i ORDER BY round(sim, 9) DESC, j ASC) AS nrank FROM sim_i) WHERE nrank <= 40),
cand AS (SELECT t."user", t.item AS src_item, nb.j AS item, nb.sim * t.rating AS score
  FROM train t JOIN nb_i nb ON t.item = nb.i WHERE nb.j <> t.item),
per_row AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "user", src_item
  ORDER BY round(score, 6) DESC, item ASC) AS r FROM cand) WHERE r <= 10),
recs AS (SELECT * FROM (SELECT "user", src_item, item, score, row_number() OVER (
  PARTITION BY "user" ORDER BY round(score, 6) DESC, item ASC, src_item ASC) AS rank
  FROM per_row) WHERE rank <= 10)"""


@sql("item_cf_per_rating")
def _():
    return f"""WITH {ITEM_SIM}, {PER_RATING},
test_items AS (SELECT DISTINCT "user", item FROM test),
rusers AS (SELECT DISTINCT "user" FROM recs)
SELECT (SELECT count(*) FROM recs r JOIN test_items t USING ("user", item))::BIGINT AS hits,
       (SELECT count(*) * 10 FROM rusers)::BIGINT AS rec_count,
       (SELECT count(*) FROM test_items JOIN rusers USING ("user"))::BIGINT AS test_count"""


@sql("item_user_index")
def _():
    return f'WITH {SPLIT} SELECT DISTINCT item, "user" FROM train'


@sql("user_cooccurrence")
def _():
    return f"WITH {SPLIT}, {cooc_sql('item', chr(34) + 'user' + chr(34), 'u', 'v')} SELECT u, v, co FROM co_u"


@sql("user_similarity")
def _():
    return f"WITH {USER_SIM} SELECT u, v, round(sim, 6) AS sim FROM sim_u"


@sql("user_cf_recommend")
def _():
    return f'WITH {user_recs_sql()} SELECT "user", item, round(score, 6) AS score, rank FROM recs'


@sql("user_cf_precision_recall")
def _():
    return f"WITH {user_recs_sql()}{HITS} {PR}"


@sql("user_cf_coverage")
def _():
    return f"WITH {user_recs_sql()} {COVERAGE}"


@sql("user_cf_popularity")
def _():
    return f"WITH {user_recs_sql()} {POPULARITY}"


@sql("sample_first")
def _():
    return (f'WITH {RATINGS} SELECT "user", item, round(rating, 6) AS rating FROM ratings '
            f'ORDER BY "user", item LIMIT 20000')


@sql("sample_fraction")
def _():
    return (f"WITH {RATINGS} SELECT \"user\", item, round(rating, 6) AS rating FROM ratings "
            f"WHERE (('0x' || substr(md5(\"user\"::VARCHAR || '|' || item::VARCHAR), 1, 8))::BIGINT "
            f"+ 0.5) / 4294967296.0 < 0.2")


# ===================================================================== ridge
PRICE_ROWS = """
price_rows AS (
  SELECT l_quantity / 50.0 AS x0, l_discount * 10.0 AS x1, l_tax * 10.0 AS x2,
         l_extendedprice / 100000.0 AS y FROM lineitem)"""

RB = (0.5, 0.1, -0.2)
RLAM = 0.1
RES = f"(y - (x0 * {RB[0]!r} + x1 * {RB[1]!r} + x2 * ({RB[2]!r})))"
RIDGE_GRAD = PRICE_ROWS + f""",
ridge_grad AS (
  SELECT 0::INTEGER AS idx, avg(-2.0 * {RES} * x0) + {2 * RLAM * RB[0]!r} AS grad FROM price_rows
  UNION ALL SELECT 1, avg(-2.0 * {RES} * x1) + {2 * RLAM * RB[1]!r} FROM price_rows
  UNION ALL SELECT 2, avg(-2.0 * {RES} * x2) + ({2 * RLAM * RB[2]!r}) FROM price_rows)"""


@sql("read_dense")
def _():
    return f"WITH {PRICE_ROWS} SELECT x0, x1, x2, y FROM price_rows"


@sql("ridge_objective")
def _():
    reg = RLAM * sum(b * b for b in RB)
    return f"WITH {PRICE_ROWS} SELECT round(avg({RES} * {RES}) + {reg!r}, 6) AS objective FROM price_rows"


@sql("ridge_gradient")
def _():
    return f"WITH {RIDGE_GRAD} SELECT idx, round(grad, 6) AS grad FROM ridge_grad"


@sql("ridge_line_search")
def _():
    return f"""WITH {RIDGE_GRAD},
g AS (SELECT max(CASE WHEN idx = 0 THEN grad END) AS g0, max(CASE WHEN idx = 1 THEN grad END) AS g1,
             max(CASE WHEN idx = 2 THEN grad END) AS g2 FROM ridge_grad),
s AS (SELECT count(*) AS n, sum({RES} * {RES}) AS ee,
             sum({RES} * (x0 * g0 + x1 * g1 + x2 * g2)) AS ew,
             sum((x0 * g0 + x1 * g1 + x2 * g2) * (x0 * g0 + x1 * g1 + x2 * g2)) AS ww
      FROM price_rows, g),
c AS (SELECT k, power(0.6, k) AS t FROM range(0, 200) r(k)),
f AS (SELECT c.k, c.t,
        (s.ee + 2 * c.t * s.ew + c.t * c.t * s.ww) / s.n + {RLAM!r} * (
          power({RB[0]!r} - c.t * g0, 2) + power({RB[1]!r} - c.t * g1, 2) + power(({RB[2]!r}) - c.t * g2, 2)) AS ft,
        s.ee / s.n + {RLAM!r} * {sum(b * b for b in RB)!r} AS f0,
        g0 * g0 + g1 * g1 + g2 * g2 AS gg
      FROM c, s, g)
SELECT round(min_by(t, k), 6) AS step FROM f WHERE NOT (ft > f0 - 0.2 * t * gg)"""


@sql("ridge_predict")
def _():
    return (f"WITH {PRICE_ROWS} SELECT y, "
            f"(x0 * {RB[0]!r} + x1 * {RB[1]!r} + x2 * ({RB[2]!r})) + 0.0 AS yhat FROM price_rows")


@sql("ridge_mse")
def _():
    return f"WITH {PRICE_ROWS} SELECT round(avg({RES} * {RES}), 6) AS mse FROM price_rows"


@sql("ridge_gradient_check")
def _():
    delta = 1e-6
    base = sum(b * b for b in RB)
    parts = []
    for i in range(3):
        reg_i = RLAM * (base - RB[i] ** 2 + (RB[i] + delta) ** 2)
        parts.append(
            f"SELECT {i}::INTEGER AS idx, round((avg(power({RES} - {delta!r} * x{i}, 2)) + {reg_i!r} "
            f"- avg({RES} * {RES}) - {RLAM * base!r}) / {delta!r}, 4) AS numeric FROM price_rows")
    num = " UNION ALL ".join(parts)
    return (f"WITH {RIDGE_GRAD}, num AS ({num}) "
            f"SELECT idx, numeric, round(grad, 4) AS analytic FROM num JOIN ridge_grad USING (idx)")


# ================================================================== logistic
SPARSE = TOKENS + """,
sx AS (SELECT doc_id AS row_id, term AS feature, count(*)::DOUBLE AS value FROM tokens
       WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY doc_id, term),
sy AS (SELECT doc_id AS row_id, (quality * 2 - 1)::INTEGER AS y FROM labels),
beta AS (SELECT feature,
  ((('0x' || substr(md5(feature), 1, 8))::BIGINT + 0.5) / 4294967296.0 - 0.5) * 0.02 AS value
  FROM (SELECT DISTINCT feature FROM sx)),
rs AS (SELECT sy.row_id, sy.y, coalesce(z.z, 0) AS z FROM sy LEFT JOIN (
  SELECT x.row_id, sum(x.value * b.value) AS z FROM sx x JOIN beta b USING (feature)
  GROUP BY x.row_id) z USING (row_id)),
bb AS (SELECT sum(value * value) AS bb FROM beta),
coef AS (SELECT row_id, CASE WHEN y * z >= 0 THEN -y * (exp(-(y * z)) / (1 + exp(-(y * z))))
                        ELSE -y * (1 / (1 + exp(y * z))) END AS c FROM rs),
grad AS (SELECT coalesce(g.feature, b.feature) AS feature,
                coalesce(g.g, 0) + 2.0 * 1.0 * coalesce(b.value, 0) AS value
         FROM (SELECT x.feature, sum(c.c * x.value) AS g FROM sx x JOIN coef c USING (row_id)
               GROUP BY x.feature) g FULL OUTER JOIN beta b ON g.feature = b.feature)"""


def loss_sql(m):
    return f"(greatest(-({m}), 0) + ln(1 + exp(-abs({m}))))"


@sql("read_sparse")
def _():
    return f"WITH {SPARSE} SELECT sy.y, sx.feature, sx.value FROM sx JOIN sy USING (row_id)"


@sql("feature_universe")
def _():
    return f"WITH {SPARSE} SELECT DISTINCT feature FROM sx"


@sql("sparse_dot")
def _():
    return f"WITH {SPARSE} SELECT row_id, round(z, 6) AS z FROM rs"


@sql("sparse_combine")
def _():
    return f"""WITH {SPARSE},
pos AS (SELECT x.feature, sum(x.value) AS value FROM sx x JOIN sy USING (row_id)
        WHERE sy.y = 1 GROUP BY x.feature)
SELECT coalesce(b.feature, p.feature) AS feature,
       round(1.0 * coalesce(b.value, 0) + (-0.001) * coalesce(p.value, 0), 6) + 0.0 AS value
FROM beta b FULL OUTER JOIN pos p ON b.feature = p.feature"""


@sql("logistic_loss")
def _():
    return (f"WITH {SPARSE} SELECT round(coalesce(sum({loss_sql('y * z')}), 0) + "
            f"1.0 * (SELECT bb FROM bb), 6) AS loss FROM rs")


@sql("logistic_gradient")
def _():
    return f"WITH {SPARSE} SELECT feature, round(value, 6) AS grad FROM grad"


@sql("logistic_line_search")
def _():
    return f"""WITH {SPARSE},
w AS (SELECT x.row_id, sum(x.value * g.value) AS w FROM sx x JOIN grad g USING (feature)
      GROUP BY x.row_id),
rsw AS (SELECT rs.row_id, rs.y, rs.z, coalesce(w.w, 0) AS w FROM rs LEFT JOIN w USING (row_id)),
sc AS (SELECT sum(coalesce(b.value, 0) * coalesce(b.value, 0)) AS bb,
              sum(coalesce(b.value, 0) * coalesce(g.value, 0)) AS bg,
              sum(coalesce(g.value, 0) * coalesce(g.value, 0)) AS gg
       FROM beta b FULL OUTER JOIN grad g ON b.feature = g.feature),
fx AS (SELECT sum({loss_sql('y * z')}) + (SELECT bb FROM bb) * 1.0 AS fx FROM rs),
c AS (SELECT k, power(0.6, k) AS t FROM range(0, 300) r(k)),
lt AS (SELECT c.k, c.t, coalesce(sum({loss_sql('rsw.y * (rsw.z - c.t * rsw.w)')}), 0) AS l
       FROM c, rsw GROUP BY c.k, c.t)
SELECT round(min_by(lt.t, lt.k), 9) AS step FROM lt, sc, fx
WHERE NOT (lt.l + 1.0 * (sc.bb - 2 * lt.t * sc.bg + lt.t * lt.t * sc.gg) > fx.fx - 0.2 * lt.t * sc.gg)"""


@sql("classification_metrics")
def _():
    return f"""WITH {SPARSE},
m AS (SELECT sum(CASE WHEN z > 0 AND y = 1 THEN 1 ELSE 0 END)::BIGINT AS tp,
             sum(CASE WHEN z > 0 AND y = -1 THEN 1 ELSE 0 END)::BIGINT AS fp,
             sum(CASE WHEN z <= 0 AND y = -1 THEN 1 ELSE 0 END)::BIGINT AS tn,
             sum(CASE WHEN z <= 0 AND y = 1 THEN 1 ELSE 0 END)::BIGINT AS fn FROM rs)
SELECT tp, fp, tn, fn,
  round(CASE WHEN tp + fp + tn + fn = 0 THEN NULL ELSE (tp + tn)::DOUBLE / (tp + fp + tn + fn) END, 6) AS accuracy,
  round(CASE WHEN tp + fp = 0 THEN NULL ELSE tp::DOUBLE / (tp + fp) END, 6) AS precision,
  round(CASE WHEN tp + fn = 0 THEN NULL ELSE tp::DOUBLE / (tp + fn) END, 6) AS recall
FROM m"""


@sql("logistic_gradient_check")
def _():
    delta = 1e-6
    return f"""WITH {SPARSE},
dl AS (SELECT x.feature, sum({loss_sql(f'rs.y * (rs.z + {delta!r} * x.value)')} - {loss_sql('rs.y * rs.z')}) AS dl
       FROM sx x JOIN rs USING (row_id) GROUP BY x.feature),
num AS (SELECT dl.feature, (dl.dl + 1.0 * ({2 * delta!r} * coalesce(b.value, 0) + {delta * delta!r})) / {delta!r} AS numeric
        FROM dl LEFT JOIN beta b USING (feature))
SELECT num.feature, round(numeric, 3) + 0.0 AS numeric, round(g.value, 3) + 0.0 AS analytic
FROM num JOIN grad g USING (feature)"""


# ============================================================ factorization
MF_RATINGS = RATINGS + """,
mf_r AS (SELECT "user", item, rating / 50.0 AS rating FROM ratings)"""


def _u(key):
    return f"((('0x' || substr(md5({key}), 1, 8))::BIGINT + 0.5) / 4294967296.0)"


def normal_sql(key):
    return (f"(sqrt(-2.0 * ln({_u(key + ' || ' + repr('#a'))})) * "
            f"cos({2 * math.pi!r} * {_u(key + ' || ' + repr('#b'))}))")


def init_sql(name, src, col, d=10, seed=1234567):
    elems = ", ".join(normal_sql(f"'{seed}|' || id::VARCHAR || '|{k}'") for k in range(d))
    return f"{name} AS MATERIALIZED (SELECT id, [{elems}] AS vec FROM (SELECT DISTINCT {col} AS id FROM {src}))"


def _dot(a, b, d):
    return "(0.0 + " + " + ".join(f"{a}[{k + 1}] * {b}[{k + 1}]" for k in range(d)) + ")"


def joined_sql(name, r, U, V, d):
    return (f"{name} AS MATERIALIZED (SELECT r.\"user\", r.item, {_dot('u.vec', 'v.vec', d)} - r.rating "
            f"AS delta, u.vec AS u, v.vec AS v FROM {r} r JOIN {U} u ON r.\"user\" = u.id "
            f"JOIN {V} v ON r.item = v.id)")


def adapt_sql(name, J, P, key, other, gamma, reg, d):
    sums = ", ".join(f"sum(2.0 * delta * {other}[{k + 1}]) AS g{k}" for k in range(d))
    new = ", ".join(f"p.vec[{k + 1}] - {gamma!r} * (g.g{k} + {2.0 * reg!r} * p.vec[{k + 1}])"
                    for k in range(d))
    return (f"{name} AS MATERIALIZED (SELECT p.id, [{new}] AS vec FROM {P} p JOIN "
            f"(SELECT {key} AS id, {sums} FROM {J} GROUP BY {key}) g USING (id))")


def sq_sql(P, d):
    return f"(SELECT coalesce(sum({_dot('vec', 'vec', d)}), 0) FROM {P})"


def mf_sql(train, test, rounds, d=10, gain=0.001, power=0.2, lam=1.0, mu=1.0, seed=1234567, p="m"):
    """CTEs of ``rounds`` GD rounds; history in {p}_hist, profiles {p}_U{rounds}, {p}_V{rounds}."""
    ctes = [init_sql(f"{p}_U0", train, '"user"', d, seed), init_sql(f"{p}_V0", train, "item", d, seed),
            f"{p}_mt AS (SELECT count(*)::DOUBLE AS n FROM {test})"]
    hist = []
    for i in range(1, rounds + 1):
        gamma = gain / i ** power
        ctes.append(joined_sql(f"{p}_J{i}", train, f"{p}_U{i-1}", f"{p}_V{i-1}", d))
        ctes.append(joined_sql(f"{p}_T{i}", test, f"{p}_U{i-1}", f"{p}_V{i-1}", d))
        ctes.append(adapt_sql(f"{p}_U{i}", f"{p}_J{i}", f"{p}_U{i-1}", '"user"', "v", gamma, lam, d))
        ctes.append(adapt_sql(f"{p}_V{i}", f"{p}_J{i}", f"{p}_V{i-1}", "item", "u", gamma, mu, d))
        hist.append(
            f"SELECT {i}::INTEGER AS iteration, "
            f"(SELECT coalesce(sum(delta * delta), 0) FROM {p}_J{i}) + {lam!r} * {sq_sql(f'{p}_U{i-1}', d)} "
            f"+ {mu!r} * {sq_sql(f'{p}_V{i-1}', d)} AS objective, "
            f"sqrt((SELECT coalesce(sum(delta * delta), 0) FROM {p}_T{i}) / (SELECT n FROM {p}_mt)) AS test_rmse")
    ctes.append(f"{p}_hist AS ({' UNION ALL '.join(hist)})")
    return ",\n".join(ctes)


def long_sql(P, kind):
    return (f"SELECT '{kind}' AS kind, id, (k - 1)::INTEGER AS k, round(vec[k], 9) AS value "
            f"FROM {P}, range(1, len(vec) + 1) t(k)")


@sql("mf_read_ratings")
def _():
    return f'WITH {MF_RATINGS} SELECT "user", item, round(rating, 9) AS rating FROM mf_r'


@sql("mf_init_profiles")
def _():
    return (f"WITH {MF_RATINGS}, {init_sql('U0', 'mf_r', chr(34) + 'user' + chr(34))}, "
            f"{init_sql('V0', 'mf_r', 'item')} {long_sql('U0', 'U')} UNION ALL {long_sql('V0', 'V')}")


@sql("mf_predict")
def _():
    return (f"WITH {MF_RATINGS}, {init_sql('U0', 'mf_r', chr(34) + 'user' + chr(34))}, "
            f"{init_sql('V0', 'mf_r', 'item')}, {joined_sql('J', 'mf_r', 'U0', 'V0', 10)} "
            f"SELECT \"user\", item, round(delta, 9) AS delta FROM J")


@sql("mf_objective")
def _():
    return (f"WITH {MF_RATINGS}, {init_sql('U0', 'mf_r', chr(34) + 'user' + chr(34))}, "
            f"{init_sql('V0', 'mf_r', 'item')}, {joined_sql('J', 'mf_r', 'U0', 'V0', 10)}, "
            f"s AS (SELECT (SELECT coalesce(sum(delta * delta), 0) FROM J) AS se, "
            f"1.0 * {sq_sql('U0', 10)} AS nu, 1.0 * {sq_sql('V0', 10)} AS nv) "
            f"SELECT round(se, 6) AS se, round(nu, 6) AS norm_u, round(nv, 6) AS norm_v, "
            f"round(se + nu + nv, 6) AS objective FROM s")


@sql("mf_adapt")
def _():
    return (f"WITH {MF_RATINGS}, {init_sql('U0', 'mf_r', chr(34) + 'user' + chr(34))}, "
            f"{init_sql('V0', 'mf_r', 'item')}, {joined_sql('J', 'mf_r', 'U0', 'V0', 10)}, "
            f"{adapt_sql('U1', 'J', 'U0', chr(34) + 'user' + chr(34), 'v', 0.001, 1.0, 10)}, "
            f"{adapt_sql('V1', 'J', 'V0', 'item', 'u', 0.001, 1.0, 10)} "
            f"{long_sql('U1', 'U')} UNION ALL {long_sql('V1', 'V')}")


@sql("mf_train")
def _():
    return (f"WITH {MF_RATINGS}, {mf_sql('mf_r', 'mf_r', 20)} "
            f"SELECT iteration, round(objective, 6) AS objective, round(test_rmse, 6) AS test_rmse "
            f"FROM m_hist")


@sql("mf_cross_validate")
def _():
    parts = [MF_RATINGS, """mf_f AS (SELECT "user", item, rating,
      ('0x' || substr(md5("user"::VARCHAR || '|' || item::VARCHAR), 1, 8))::BIGINT % 5 AS fold
      FROM mf_r)"""]
    sel = []
    for f in range(5):
        parts.append(f"tr{f} AS (SELECT \"user\", item, rating FROM mf_f WHERE fold <> {f})")
        parts.append(f"te{f} AS (SELECT \"user\", item, rating FROM mf_f WHERE fold = {f})")
        parts.append(mf_sql(f"tr{f}", f"te{f}", 20, p=f"f{f}"))
        sel.append(f"SELECT {f}::INTEGER AS fold, test_rmse FROM f{f}_hist WHERE iteration = 20")
    return ("WITH " + ",\n".join(parts) + "\nSELECT fold, round(test_rmse, 6) AS test_rmse, "
            "round(avg(test_rmse) OVER (), 6) AS mean_rmse FROM (" + " UNION ALL ".join(sel) + ")")


@sql("mf_save_profiles")
def _():
    return (f"WITH {MF_RATINGS}, {mf_sql('mf_r', 'mf_r', 20)} "
            f"{long_sql('m_U20', 'U')} UNION ALL {long_sql('m_V20', 'V')}")


# ------------------------------------------------- ridge training (Gram form)
def _rdot(a, b):
    return "(0.0 + " + " + ".join(f"({x}) * ({y})" for x, y in zip(a, b)) + ")"


def _robj(b, lam, d=3):
    """F(b) from the statistics row, in the same operation order as the driver code."""
    xty = [f"xy{i}" for i in range(d)]
    mv = ["(0.0 + " + " + ".join(f"xx{min(i, j)}{max(i, j)} * ({b[j]})" for j in range(d)) + ")"
          for i in range(d)]
    q = f"(yy - 2.0 * {_rdot(b, xty)} + {_rdot(b, mv)})"
    return f"({q} / n + {lam!r} * {_rdot(b, b)})"


def _rgrad(b, lam, d=3):
    mv = ["(0.0 + " + " + ".join(f"xx{min(i, j)}{max(i, j)} * ({b[j]})" for j in range(d)) + ")"
          for i in range(d)]
    return [f"(2.0 * ({mv[i]} - xy{i}) / n + {2.0 * lam!r} * ({b[i]}))" for i in range(d)]


def ridge_train_sql(lam=0.1, max_iter=100, eps=0.01, d=3, src=None, tail=None):
    stats = ", ".join(["count(*)::DOUBLE AS n", "sum(y * y) AS yy"]
                      + [f"sum(x{i} * y) AS xy{i}" for i in range(d)]
                      + [f"sum(x{i} * x{j}) AS xx{i}{j}" for i in range(d) for j in range(i, d)])
    ctes = [PRICE_ROWS.strip() if src is None else src,
            f"st AS (SELECT {stats} FROM {'price_rows' if src is None else 'train_rows'})"]
    b0 = ["0.0"] * d
    g0 = _rgrad(b0, lam, d)
    cols = ", ".join([f"0.0 AS b{i}" for i in range(d)] + [f"{g0[i]} AS g{i}" for i in range(d)])
    ctes.append(f"s0 AS MATERIALIZED (SELECT {cols} FROM st)")
    b = [f"b{i}" for i in range(d)]
    g = [f"g{i}" for i in range(d)]
    for it in range(1, max_iter + 1):
        bt = [f"b{i} - t * g{i}" for i in range(d)]
        gg = _rdot(g, g)
        ctes.append(
            f"ls{it} AS (SELECT min(k) AS k FROM (SELECT *, power(0.6, q.k) AS t "
            f"FROM s{it - 1}, st, range(0, 400) q(k)) "
            f"WHERE NOT ({_robj(bt, lam, d)} > {_robj(b, lam, d)} - 0.2 * t * {gg}))")
        nb = [f"(p.b{i} - power(0.6, l.k) * p.g{i})" for i in range(d)]
        ng = _rgrad([f"nb{i}" for i in range(d)], lam, d)
        ctes.append(
            f"s{it} AS MATERIALIZED (SELECT {', '.join(f'nb{i} AS b{i}' for i in range(d))}, "
            f"{', '.join(f'{ng[i]} AS g{i}' for i in range(d))} FROM "
            f"(SELECT {', '.join(f'{nb[i]} AS nb{i}' for i in range(d))} FROM s{it - 1} p, ls{it} l), st)")
    allr = " UNION ALL ".join(
        f"SELECT {it} AS it, {', '.join(b)}, sqrt({_rdot(g, g)}) AS gn FROM s{it}"
        for it in range(0, max_iter + 1))
    ctes.append(f"path AS MATERIALIZED ({allr})")
    ctes.append(f"stop AS (SELECT coalesce(min(it), {max_iter}) AS it FROM path WHERE gn <= {eps!r})")
    ctes.append("fin AS (SELECT * FROM path WHERE it = (SELECT it FROM stop))")
    out = " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS idx, round(b{i}, 6) AS beta, round(gn, 6) AS grad_norm, "
        f"it::INTEGER AS iterations FROM fin" for i in range(d))
    return "WITH " + ",\n".join(ctes) + "\n" + (out if tail is None else tail)


@sql("ridge_train")
def _():
    return ridge_train_sql()


# --------------------------------------------- logistic training (unrolled)
def logistic_train_sql(lam=1.0, max_iter=100, eps=0.01, each_step=False):
    hu = "((('0x' || substr(md5(row_id::VARCHAR), 1, 8))::BIGINT + 0.5) / 4294967296.0)"
    ctes = [TOKENS.strip(), """sx AS (SELECT doc_id AS row_id, term AS feature, count(*)::DOUBLE AS value
  FROM tokens WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY doc_id, term)""",
            "sy AS (SELECT doc_id AS row_id, (quality * 2 - 1)::INTEGER AS y FROM labels)",
            f"ytr AS (SELECT * FROM sy WHERE NOT ({hu} < 0.25))",
            f"yte AS (SELECT * FROM sy WHERE {hu} < 0.25)",
            "xtr AS MATERIALIZED (SELECT * FROM sx WHERE row_id IN (SELECT row_id FROM ytr))",
            "xte AS (SELECT * FROM sx WHERE row_id IN (SELECT row_id FROM yte))",
            "b0 AS (SELECT NULL::VARCHAR AS feature, 0.0::DOUBLE AS value WHERE false)"]
    coef = ("CASE WHEN y * z >= 0 THEN -y * (exp(-(y * z)) / (1 + exp(-(y * z)))) "
            "ELSE -y * (1 / (1 + exp(y * z))) END")
    for i in range(1, max_iter + 1):
        p = f"b{i - 1}"
        ctes += [
            f"z{i} AS MATERIALIZED (SELECT y.row_id, y.y, coalesce(z.z, 0) AS z FROM ytr y LEFT JOIN "
            f"(SELECT x.row_id, sum(x.value * b.value) AS z FROM xtr x JOIN {p} b USING (feature) "
            f"GROUP BY x.row_id) z USING (row_id))",
            f"g{i} AS MATERIALIZED (SELECT coalesce(g.feature, b.feature) AS feature, "
            f"coalesce(g.g, 0) + {2.0 * lam!r} * coalesce(b.value, 0) AS value FROM "
            f"(SELECT x.feature, sum(c.c * x.value) AS g FROM xtr x JOIN "
            f"(SELECT row_id, {coef} AS c FROM z{i}) c USING (row_id) GROUP BY x.feature) g "
            f"FULL OUTER JOIN {p} b ON g.feature = b.feature)",
            f"sc{i} AS MATERIALIZED (SELECT coalesce(sum(coalesce(b.value, 0) * coalesce(b.value, 0)), 0) AS bb, "
            f"coalesce(sum(coalesce(b.value, 0) * coalesce(g.value, 0)), 0) AS bg, "
            f"coalesce(sum(coalesce(g.value, 0) * coalesce(g.value, 0)), 0) AS gg "
            f"FROM {p} b FULL OUTER JOIN g{i} g ON b.feature = g.feature)",
            f"w{i} AS MATERIALIZED (SELECT z.row_id, z.y, z.z, coalesce(w.w, 0) AS w FROM z{i} z LEFT JOIN "
            f"(SELECT x.row_id, sum(x.value * g.value) AS w FROM xtr x JOIN g{i} g USING (feature) "
            f"GROUP BY x.row_id) w USING (row_id))",
            f"fx{i} AS (SELECT coalesce(sum({loss_sql('y * z')}), 0) + {lam!r} * (SELECT bb FROM sc{i}) "
            f"AS fx FROM w{i})",
            f"lt{i} AS (SELECT q.k, power(0.6, q.k) AS t, coalesce(sum("
            f"{loss_sql('w.y * (w.z - power(0.6, q.k) * w.w)')}), 0) AS l "
            f"FROM range(0, 300) q(k), w{i} w GROUP BY q.k)",
            f"t{i} AS (SELECT power(0.6, min(lt.k)) AS t FROM lt{i} lt, sc{i} sc, fx{i} f WHERE NOT ("
            f"lt.l + {lam!r} * (sc.bb - 2 * lt.t * sc.bg + lt.t * lt.t * sc.gg) > f.fx - 0.2 * lt.t * sc.gg))",
            f"b{i} AS MATERIALIZED (SELECT coalesce(b.feature, g.feature) AS feature, "
            f"1.0 * coalesce(b.value, 0) + (-(SELECT t FROM t{i})) * coalesce(g.value, 0) AS value "
            f"FROM {p} b FULL OUTER JOIN g{i} g ON b.feature = g.feature)",
        ]
    gns = " UNION ALL ".join(f"SELECT {i} AS it, sqrt(gg) AS gn FROM sc{i}" for i in range(1, max_iter + 1))
    ctes.append(f"gns AS MATERIALIZED ({gns})")
    ctes.append(f"stop AS (SELECT coalesce(min(it), {max_iter}) AS it FROM gns WHERE gn <= {eps!r})")
    if each_step:
        for i in range(1, max_iter + 1):
            ctes.append(f"zt{i} AS (SELECT y.y, coalesce(z.z, 0) AS z FROM yte y LEFT JOIN "
                        f"(SELECT x.row_id, sum(x.value * b.value) AS z FROM xte x JOIN b{i} b USING (feature) "
                        f"GROUP BY x.row_id) z USING (row_id))")
        steps = " UNION ALL ".join(
            f"SELECT {i} AS it, (SELECT fx FROM fx{i}) AS loss, (SELECT t FROM t{i}) AS t, "
            f"count(*) FILTER (WHERE z > 0 AND y = 1) AS tp, count(*) FILTER (WHERE z > 0 AND y = -1) AS fp, "
            f"count(*) FILTER (WHERE z <= 0 AND y = -1) AS tn, count(*) FILTER (WHERE z <= 0 AND y = 1) AS fn FROM zt{i}"
            for i in range(1, max_iter + 1))
        ctes.append(f"steps AS ({steps})")
        return "WITH " + ",\n".join(ctes) + """
SELECT (it - 1)::INTEGER AS k, round(loss, 5) AS loss, round(gn, 5) AS grad_norm, round(t, 9) AS step,
  round((tp + tn)::DOUBLE / nullif(tp + fp + tn + fn, 0), 6) AS accuracy,
  round(tp::DOUBLE / nullif(tp + fp, 0), 6) AS precision, round(tp::DOUBLE / nullif(tp + fn, 0), 6) AS recall
FROM steps JOIN gns USING (it) WHERE it <= (SELECT it FROM stop)"""
    bs = " UNION ALL ".join(f"SELECT {i} AS it, feature, value FROM b{i}" for i in range(1, max_iter + 1))
    ctes.append(f"fin AS (SELECT feature, value FROM ({bs}) WHERE it = (SELECT it FROM stop))")
    ctes.append("zt AS (SELECT y.row_id, y.y, coalesce(z.z, 0) AS z FROM yte y LEFT JOIN "
                "(SELECT x.row_id, sum(x.value * b.value) AS z FROM xte x JOIN fin b USING (feature) "
                "GROUP BY x.row_id) z USING (row_id))")
    ctes.append("""m AS (SELECT sum(CASE WHEN z > 0 AND y = 1 THEN 1 ELSE 0 END)::BIGINT AS tp,
             sum(CASE WHEN z > 0 AND y = -1 THEN 1 ELSE 0 END)::BIGINT AS fp,
             sum(CASE WHEN z <= 0 AND y = -1 THEN 1 ELSE 0 END)::BIGINT AS tn,
             sum(CASE WHEN z <= 0 AND y = 1 THEN 1 ELSE 0 END)::BIGINT AS fn FROM zt)""")
    return ("WITH " + ",\n".join(ctes) + """
SELECT tp, fp, tn, fn,
  round(CASE WHEN tp + fp + tn + fn = 0 THEN NULL ELSE (tp + tn)::DOUBLE / (tp + fp + tn + fn) END, 6) AS accuracy,
  (SELECT it FROM stop)::INTEGER AS iterations,
  round((SELECT gn FROM gns WHERE it = (SELECT it FROM stop)), 6) AS grad_norm
FROM m""")


@sql("logistic_train")
def _():
    return logistic_train_sql()


@sql("logistic_train_steps")
def _():
    return logistic_train_sql(each_step=True)


@sql("ridge_model_roundtrip")
def _():
    src = """keyed AS (
  SELECT l_quantity / 50.0 AS x0, l_discount * 10.0 AS x1, l_tax * 10.0 AS x2,
         l_extendedprice / 100000.0 AS y,
         ('0x' || substr(md5(l_orderkey::VARCHAR || '|' || l_linenumber::VARCHAR), 1, 8))::BIGINT % 4
           AS fold
  FROM lineitem),
train_rows AS (SELECT x0, x1, x2, y FROM keyed WHERE fold <> 0)"""
    tail = ("SELECT round(avg(power(y - (0.0 + x0 * b0 + x1 * b1 + x2 * b2), 2)) + 0.0, 6) AS mse "
            "FROM keyed, fin WHERE fold = 0")
    return ridge_train_sql(src=src, tail=tail)


# ------------------------------------------------------ stored tables, files
@sql("tfidf_tables")
def _():
    return f"""WITH {CORPUS_TFIDF},
lang_tf AS (SELECT lang, term, count(*)::BIGINT AS tf FROM tokens GROUP BY lang, term)
SELECT lang, term, tf, round(tf * idf, 6) AS tfidf FROM lang_tf JOIN idf USING (term)"""


@sql("text_files")
def _():
    return ORACLE["doc_term_frequency"]


@sql("interactions_header")
def _():
    return ORACLE["read_interactions"]


@sql("cosine_tables")
def _():
    return ORACLE["cosine_similarity"]


@sql("sparse_model_roundtrip")
def _():
    return ORACLE["sparse_dot"]


@sql("ridge_train_pass")
def _():
    return ORACLE["ridge_train"]


@sql("item_cf_per_rating_lists")
def _():
    return f"""WITH {ITEM_SIM}, {PER_RATING}
SELECT "user", src_item, item, round(score, 6) AS score, rank FROM recs"""


@sql("node_color_join")
def _():
    return f"""WITH {PART_SUPPLIER}, {drop_one_edge_sql('g1', 'part_supplier')},
{wl_sql('part_supplier', p='wa')},
{wl_sql('g1', p='wb')}
SELECT node, wa_out.color AS color_1, wb_out.color AS color_2 FROM wa_out JOIN wb_out USING (node)"""


@sql("one_hot")
def _():
    return """SELECT row_id, feature, 1.0::DOUBLE AS value, CASE WHEN balance > 0 THEN 1 ELSE -1 END AS y FROM (
  SELECT c_custkey AS row_id, 'c_mktsegment=' || c_mktsegment AS feature, c_acctbal AS balance FROM customer
  UNION ALL SELECT c_custkey, 'c_nationkey=' || c_nationkey::VARCHAR, c_acctbal FROM customer)
WHERE feature IS NOT NULL"""
