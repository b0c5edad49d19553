"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

OP6 = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""

#: The CRC's table is built from its rule, eight halvings of each byte's value.
OP2 = r"""
WITH RECURSIVE crc(i, k, v) AS (
  SELECT i::UBIGINT, 0, i::UBIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM crc WHERE k < 8
), tab AS (SELECT list(v ORDER BY i) AS t FROM crc WHERE k = 8),
d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(doc_id::VARCHAR, '') AS key FROM documents),
bytes AS (
  SELECT doc_id, key, strlen(text) + 16 AS size,
    list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::UBIGINT) AS b FROM d
), c AS (
  SELECT doc_id, key, size,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, b), lambda a, x: xor(a >> 8, t[((xor(a, x) & 255) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM bytes, tab
), regions AS (SELECT '/r' || r AS path, CASE WHEN r = 4 THEN 1.0 ELSE 10.0 END AS w FROM range(5) x(r)),
tree AS (
  SELECT '/r' || r AS region, '/r' || r || '/k' || k AS rack, '/r' || r || '/k' || k || '/' || ((r * 5 + k) * 2 + s) AS leaf
  FROM range(4) a(r), range(5) b(k), range(2) e(s)
), region AS (
  SELECT key, arg_min(path, draw) FILTER (path <> '/r4') AS old, arg_min(path, draw) AS new FROM (
    SELECT DISTINCT key, path, -ln((('0x' || substr(md5(path || '/' || key), 1, 13))::BIGINT + 0.5) / 4503599627370496e0) / w AS draw FROM d, regions
  ) GROUP BY key
), rack AS (
  SELECT key, old, new, arg_min(rack, -ln((('0x' || substr(md5(rack || '/' || key), 1, 13))::BIGINT + 0.5) / 4503599627370496e0)) AS rack
  FROM region JOIN tree ON tree.region = old GROUP BY ALL
), leaf AS (
  SELECT key, old, new, arg_min(leaf, -ln((('0x' || substr(md5(leaf || '/' || key), 1, 13))::BIGINT + 0.5) / 4503599627370496e0)) AS leaf
  FROM rack JOIN tree USING (rack) GROUP BY ALL
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, regexp_extract(leaf, '[0-9]+$')::INTEGER AS shard,
  row_number() OVER (PARTITION BY leaf ORDER BY substr(md5(key), 1, 2), doc_id, size, text_crc32) - 1 AS slot,
  CASE WHEN new = '/r4' THEN 40 ELSE regexp_extract(leaf, '[0-9]+$')::INTEGER END AS grown_shard
FROM c JOIN leaf USING (key)
"""


def _spans(kind: int, pattern: str, options: str = "''", least: str | None = None) -> str:
    """Rows (doc_id, kind, s, e): matches are found one after the other in what is left of the text."""
    return f"""
  SELECT doc_id, {kind} AS kind, s, e FROM (
    SELECT doc_id, unnest(list_transform(range(1, len(hits) + 1), lambda i:
        {{'s': (list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda h: length(h))), 0))::BIGINT,
          'e': (list_sum(list_transform(gaps[1:i], lambda g: length(g))) + list_sum(list_transform(hits[1:i], lambda h: length(h))))::BIGINT,
          'n': length({"own[i]" if least else "hits[i]"})}}), recursive := true)
    FROM (SELECT doc_id, regexp_extract_all(text, {pattern}, 0, {options}) AS hits, regexp_extract_all(text, {pattern}, {2 if least else 0}, {options}) AS own,
            string_split_regex(text, {pattern}, {options}) AS gaps FROM d)
  ) WHERE n >= {least or 1}"""


_ASSIGN = r"""'([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""

OP8 = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), found AS ("
    + " UNION ALL ".join(
        [
            _spans(1, _ASSIGN, least="6"),
            _spans(2, "'AKIA[A-Z0-9]{16,}'"),
            _spans(3, "'[0-9a-f]{24,}'"),
            _spans(4, "'-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----'"),
            _spans(5, "'gh[pousr]_[A-Za-z0-9]{36,}'"),
            _spans(6, r"'eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}'"),
        ]
    )
    + """), joined AS (
  SELECT doc_id, count(*) FILTER (kind = 1) AS n_assign, count(*) FILTER (kind = 2) AS n_access, count(*) FILTER (kind = 3) AS n_hex,
    string_agg(['assign', 'access', 'hex', 'pem', 'github', 'jwt'][kind] || ':' || s || ':' || e, ',' ORDER BY s, kind, e) FILTER (kind <= 3) AS base,
    string_agg(['assign', 'access', 'hex', 'pem', 'github', 'jwt'][kind] || ':' || s || ':' || e, ',' ORDER BY s, kind, e) AS spans
  FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(d.text) AS blob
FROM d LEFT JOIN joined USING (doc_id)
"""
)

_CRC = """crc(i, k, v) AS (
  SELECT i::UBIGINT, 0, i::UBIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM crc WHERE k < 8
), tab AS (SELECT list(v ORDER BY i) AS t FROM crc WHERE k = 8)"""

OP12 = (
    "WITH RECURSIVE "
    + _CRC
    + r""", runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), pairs AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (
  SELECT doc_id, run, n, list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR || ':' || run)), '..'), lambda x: ('0x' || x)::UBIGINT) AS b FROM pairs
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::UBIGINT, b), lambda a, x: xor(a >> 8, t[((xor(a, x) & 255) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS h FROM bytes, tab
), noisy AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word, n FROM hashed
), words AS (SELECT word, sum(n)::BIGINT AS n FROM noisy WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
keys AS (
  SELECT word, unnest(list_transform(range(1, length(word) + 1), lambda i: substr(word, 1, i - 1) || '_' || substr(word, i + 1))) AS key FROM words
  UNION ALL SELECT word, unnest(list_transform(range(1, length(word) + 2), lambda i: substr(word, 1, i - 1) || '_' || substr(word, i))) FROM words
), near AS (SELECT DISTINCT a.word, b.word AS other FROM keys a JOIN keys b USING (key) WHERE a.word <> b.word),
best AS (
  SELECT near.word, count(*) AS n_near, arg_min(other, (-o.n, other)) AS top, max(o.n) AS top_n FROM near JOIN words o ON o.word = other GROUP BY near.word
), formed AS (
  SELECT words.word, CASE WHEN top_n >= 5 * n THEN top END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 5 * n THEN top_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), walk(word, root, next) AS (
  SELECT word, word, form FROM formed
  UNION ALL SELECT walk.word, formed.word, formed.form FROM walk JOIN formed ON formed.word = walk.next
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM walk WHERE next IS NULL) USING (word)
"""
)

#: Phrases keep their infrequent words out early: no candidate and no half of one holds any.
OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), listed AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT lang, id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM listed),
single AS (SELECT lang, word, count(*) AS a FROM placed GROUP BY ALL),
sizes AS (SELECT lang, sum(a)::BIGINT AS n FROM single GROUP BY lang),
good AS (SELECT placed.* FROM placed JOIN single USING (lang, word) WHERE a >= 100),
runs AS (
  SELECT lang, word AS w1, [word, lead(word, 1) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w, lead(word, 4) OVER w] AS w,
    1 + coalesce(list_sum([(lead(i, 1) OVER w = i + 1)::INT, (lead(i, 2) OVER w = i + 2)::INT, (lead(i, 3) OVER w = i + 3)::INT, (lead(i, 4) OVER w = i + 4)::INT]), 0) AS most
  FROM good WINDOW w AS (PARTITION BY lang, id ORDER BY i)
),
f AS (
  SELECT lang, g, s, count(*) AS a FROM (SELECT lang, array_to_string(w[1:s], ' ') AS g, s FROM runs, range(1, 6) k(s) WHERE s <= most)
  GROUP BY ALL HAVING count(*) >= 100
),
c AS (SELECT lang, string_split(g, ' ') AS w, s, a FROM f WHERE s > 1),
held AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS g, max(a) AS most
  FROM (SELECT *, unnest(range(2, s)) AS k FROM c), range(1, 6) r(i) WHERE i + k - 1 <= s GROUP BY ALL
),
cut AS (
  SELECT c.lang, w, s, a, unnest(range(1, s)) AS k FROM c LEFT JOIN held ON held.lang = c.lang AND held.g = array_to_string(w, ' ')
  WHERE held.most IS NULL OR 100 * held.most < 100 * a
),
scored AS (
  SELECT cut.lang, array_to_string(cut.w, ' ') AS phrase, cut.k, cut.a, x.a AS l, y.a AS r, n, ((1000::HUGEINT * cut.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.g = array_to_string(cut.w[1:cut.k], ' ')
  JOIN f y ON y.lang = cut.lang AND y.g = array_to_string(cut.w[cut.k + 1:cut.s], ' ') JOIN sizes ON sizes.lang = cut.lang
), worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM worst
)
SELECT * FROM ranked WHERE rank <= 2000
"""

ORACLE = {"op2_sharding": OP2, "op6_exact_dedup": OP6, "op8_secret_scan": OP8, "op12_spelling_variants": OP12, "op13_collocations": OP13}
