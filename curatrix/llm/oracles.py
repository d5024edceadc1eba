"""DuckDB SQL with the same results as the registered queries."""

from __future__ import annotations

from curatrix.llm.decontaminate import MASKS, SHORT

#: Only A-Z are lower-cased.
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, {WORDS.format(ASCII_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS s FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m.component_id FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) m USING (doc_id)
"""

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS.format("coalesce(text, '')")})::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS u FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM sized GROUP BY source
), leveled AS (
  SELECT *, 3 * source_size AS cap, ((sum(source_size) OVER ())::BIGINT
    - coalesce(sum(3 * source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
    / (sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS lvl FROM sums
), goals AS (
  SELECT source, source_size, CASE WHEN cap <= w * lvl THEN cap::DOUBLE
    ELSE w * max(CASE WHEN NOT cap <= w * lvl THEN lvl END) OVER () END AS target FROM leveled
), passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS q FROM goals
), parts AS (
  SELECT source, u >> 30 AS part, sum(size)::BIGINT AS words FROM sized GROUP BY 1, 2
), running AS (
  SELECT p.source, q, part, words, target - q * source_size AS rest, sum(words) OVER (PARTITION BY p.source ORDER BY part)::BIGINT AS upto
  FROM parts p JOIN passes g ON p.source IS NOT DISTINCT FROM g.source
), edges AS (
  SELECT source, max(rest) AS rest, coalesce(min(CASE WHEN upto > rest THEN part END), max(part)) AS part FROM running GROUP BY source
), cuts AS (
  SELECT r.source, (r.part + CASE WHEN r.upto - r.rest < r.rest - (r.upto - r.words) THEN 1 ELSE 0 END) << 30 AS cut
  FROM running r JOIN edges e ON r.source IS NOT DISTINCT FROM e.source AND r.part = e.part
)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size > 0 THEN size * least(q + CASE WHEN u < cut THEN 1 ELSE 0 END, 3) ELSE 0 END::BIGINT AS taken
FROM sized s JOIN passes g ON s.source IS NOT DISTINCT FROM g.source JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source
"""

_TOKENS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '')"
#: The tokens that each mask chooses, and runs of 1 to 7 tokens for items of that length.
_CHOSEN = {k: [i for i, bit in enumerate(mask) if bit == "1"] for k, mask in enumerate(MASKS)} | {-n: list(range(n)) for n in range(1, SHORT)}
_SEEDS = " UNION ALL ".join(
    f"SELECT r, p, {k} AS mask, concat_ws(' ', {', '.join(f't[p + {i}]' for i in chosen)}) AS seed FROM {{0}}, unnest(range(1, len(t) - {chosen[-1]} + 1)) AS u(p)"
    + (f" WHERE {{1}}len(t) {f'= {-k}' if k < 0 else f'>= {SHORT}'}")
    for k, chosen in _CHOSEN.items()
)

LEAKS = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_TOKENS} AS t FROM (SELECT DISTINCT doc_id, text FROM documents)
), b AS (
  SELECT row_number() OVER () AS r, item_id, {_TOKENS} AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)
), ds AS (
  {_SEEDS.format("d", "true OR ")}
), bs AS (
  {_SEEDS.format("b", "")}
), lines AS (
  SELECT DISTINCT ds.r AS dr, bs.r AS br, ds.p - bs.p AS doc_token FROM ds JOIN bs ON ds.mask = bs.mask AND ds.seed = bs.seed
), agree AS (
  SELECT dr, br, doc_id, item_id, doc_token, len(b.t) AS n, q, CASE WHEN d.t[q + doc_token] = b.t[q] AND q + doc_token > 0 THEN 1 ELSE 0 END AS same
  FROM lines JOIN d ON d.r = dr JOIN b ON b.r = br, unnest(range(1, len(b.t) + 1)) AS u(q)
), windows AS (
  SELECT *, sum(same) OVER (PARTITION BY dr, br, doc_token ORDER BY q ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS s FROM agree
), told AS (
  SELECT doc_id, item_id, doc_token, max(s)::INT AS agreeing, least(20, n)::INT AS compared FROM windows
  WHERE q >= least(20, n) GROUP BY dr, br, doc_id, item_id, doc_token, n HAVING max(s) * 100 >= least(20, n) * CASE WHEN n < {SHORT} THEN 100 ELSE 75 END
), best AS (
  SELECT doc_id, item_id, doc_token, max(struct_pack(agreeing := agreeing, compared := compared)) AS e FROM told GROUP BY ALL
)
SELECT doc_id, item_id, doc_token::INT AS doc_token, e.agreeing AS agreeing, e.compared AS compared FROM best
"""

VECTORS = """
WITH RECURSIVE pairs AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.95
), reach(x, y) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.x, pairs.y FROM reach JOIN pairs ON pairs.x = reach.y
), groups AS (
  SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY 1
)
SELECT vec_id, (SELECT count(*) FROM pairs WHERE x = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM groups
"""

SPELLING = rf"""
WITH RECURSIVE tables AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda a, j: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS c FROM range(256) r(i))
), runs AS (
  SELECT d, run, count(*) AS k FROM (SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[a-zÀ-ÿ]{{5,}}')) AS run FROM documents) GROUP BY ALL
), hexed AS (
  SELECT d, run, k, hex(encode(d || ':' || run)) AS x FROM runs
), hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(list_transform(range(1, len(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295)) AS h FROM hexed, tables
), damaged AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, 2 + h % length(run)) ELSE run END AS word, k FROM hashed
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
), cuts AS (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS u(i)
), pairs AS (
  SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT word, rest FROM cuts SEMI JOIN words w ON w.word = rest
  UNION SELECT rest, word FROM cuts SEMI JOIN words w ON w.word = rest
), near AS (
  SELECT a AS word, count(*) AS n_near, arg_min(b, (-n, b)) AS best, max(n) AS m FROM pairs JOIN words ON b = word GROUP BY a
), forms AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN best END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n FROM words w LEFT JOIN near USING (word)
), chains(word, root) AS (
  SELECT word, word FROM forms UNION ALL SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, f.n_near::BIGINT AS n_near, f.form_n FROM forms f JOIN chains c USING (word) WHERE c.root IN (SELECT word FROM forms WHERE form IS NULL)
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM scores QUALIFY rank <= 5
"""

_TERMS = rf"regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents
), sizes AS (
  SELECT r, doc_id, len(t)::BIGINT AS n FROM d WHERE len(t) > 0
), totals AS (
  SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM sizes
), postings AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals GROUP BY term, big_n
), asked AS (
  SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
), scores AS (
  SELECT item_id, doc_id, r, sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (r), totals GROUP BY item_id, doc_id, r
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM scores WHERE score > 0 QUALIFY rank <= 10
"""

#: Prefix, head and value of each match of a kind (0 assign, 1 access, 2 hex), and the least length of its value.
_EITHER = {w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")}
_BASE = (
    (0, rf"""(?s)(.*?)((?:{"|".join(_EITHER.values())})["'']?\x20*[:=]\x20*["'']?)([A-Za-z0-9+/_.=-]+)""", 8), (1, "(?s)(.*?)()(AKIA[A-Z0-9]+)", 16), (2, "(?s)(.*?)()([0-9a-f]+)", 32),
)
_PIECES = " UNION ALL ".join(f"SELECT r, {k} AS k, {n} AS least, {', '.join(f"regexp_extract_all(t, '{p}', {i}) AS g{i}" for i in (1, 2, 3))} FROM d" for k, p, n in _BASE)

SECRETS = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), pieces AS (
  {_PIECES}
), flat AS (
  SELECT r, k, least, i, length(g1[i]) AS before, length(g2[i]) AS head, length(g3[i]) AS value FROM pieces, unnest(range(1, len(g1) + 1)) AS u(i)
), placed AS (
  SELECT r, k, least, head, value, sum(before + head + value) OVER (PARTITION BY r, k ORDER BY i)::BIGINT AS upto FROM flat
), told AS (
  SELECT r, k, upto - head - value AS first, upto FROM placed WHERE value >= least
)
SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  sha256(coalesce(string_agg(['assign', 'access', 'hex'][k + 1] || ':' || first || ':' || upto, ',' ORDER BY first, k), '')) AS base_sha256
FROM d LEFT JOIN told USING (r) GROUP BY r, doc_id
"""

#: The vectors with copies of some: scaled, moved a little, and exact ones.
COPIES = """copies AS (SELECT vec_id, embedding FROM embeddings
  UNION ALL SELECT vec_id + 1000000000000, list_transform(embedding, lambda x: (3 * x)::FLOAT) FROM embeddings WHERE vec_id % 3 = 0
  UNION ALL SELECT vec_id + 2000000000000, list_transform(range(1, len(embedding) + 1), lambda i: (embedding[i]::DOUBLE + CASE WHEN i % 8 = vec_id % 8 THEN 0.02 ELSE 0 END)::FLOAT) FROM embeddings WHERE vec_id % 2 = 0
  UNION ALL SELECT vec_id + 3000000000000, embedding FROM embeddings WHERE vec_id % 5 = 0)"""
PLANTED = VECTORS.replace("WITH RECURSIVE", f"WITH RECURSIVE {COPIES},").replace("FROM embeddings a JOIN embeddings b", "FROM copies a JOIN copies b").replace("SELECT vec_id, vec_id FROM embeddings UNION", "SELECT vec_id, vec_id FROM copies UNION")

SQL = {
    "op2_benchmark_decontamination": LEAKS,
    "op4_ngram_jaccard_join": JACCARD,
    "op5_mixing": MIXING,
    "op9_embedding_near_dedup": VECTORS,
    "op11_spelling_variants": SPELLING,
    "op12_exact_top_k": TOP_K,
    "op13_ranked_search": RANKED,
    "secret_base_spans": SECRETS,
    "embedding_copies": PLANTED,
}
