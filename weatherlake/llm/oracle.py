"""SQL counterparts for DuckDB."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOWER} AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""

TOP = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5
"""

MIX = r"""
WITH rows AS (
  SELECT doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), keyed AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5)
             / 281474976710656.0::DOUBLE)
         / (1.0::DOUBLE / (1.0::DOUBLE + abs(coalesce(length(text)::DOUBLE / greatest(size, 1)::DOUBLE, 0.0::DOUBLE) - 6.0::DOUBLE) / 4.0::DOUBLE)) AS key
  FROM rows
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source
), turns AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS w,
         (sum(source_size) OVER ())::BIGINT AS total
  FROM sources
), capped AS (
  SELECT *, total - 3 * coalesce(sum(source_size) OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
         (sum(w) OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS ws
  FROM turns
), level AS (
  SELECT rest AS level_rest, ws AS level_ws FROM capped
  WHERE w * rest < 3 * source_size * ws
  ORDER BY source_size::DOUBLE / w, source NULLS LAST LIMIT 1
), targets AS (
  SELECT source, source_size,
         CASE WHEN w * rest >= 3 * source_size * ws THEN (3 * source_size)::DOUBLE
              ELSE (w * level_rest)::DOUBLE / level_ws::DOUBLE END AS target
  FROM capped LEFT JOIN level ON true
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM targets
), ahead AS (
  SELECT k.*, source_size, target, epochs, target - epochs * source_size AS budget,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
       size * (epochs + CASE WHEN budget - before > size::DOUBLE / 2 THEN 1 ELSE 0 END) AS taken
FROM ahead
"""

CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, regexp_replace(regexp_replace(replace(x, '\', '\\'), '([<\[])(/?s>)', '\1\\\2', 'g'),
                           '(\[)(/?INST\])', '\1\\\2', 'g') AS e
  FROM (SELECT *, role || chr(1) || text AS x FROM rows)
), formed AS (
  SELECT *, CASE WHEN regexp_matches(x, '</?s>|\[/?INST\]') OR regexp_replace(role, '(?s)\\(.)', '\1', 'g') <> role
                   OR regexp_replace(text, '(?s)\\(.)', '\1', 'g') <> text
                 THEN length(e) ELSE length(x) END - 1 + 20 AS chars
  FROM escaped
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM formed GROUP BY conv_id
"""

# crc32 is worked out byte by byte: a step for each of the 256 byte values, then a fold over the bytes of a text.
SPELLING = rf"""
WITH RECURSIVE bits AS (
  SELECT b AS byte, b::BIGINT AS c, 0 AS i FROM range(256) t(b)
  UNION ALL SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i + 1 FROM bits WHERE i < 8
), steps AS (
  SELECT list(c ORDER BY byte) AS t FROM bits WHERE i = 8
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), pairs AS (
  SELECT doc, run, count(*) AS n FROM runs GROUP BY doc, run
), hashed AS (
  SELECT *, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || x[i:i + 1])::BIGINT)),
           lambda c, b: xor(c // 256, t[(xor(c, b) % 256 + 1)::BIGINT]))) AS h
  FROM (SELECT *, hex(encode(doc || ':' || run)) AS x FROM pairs), steps
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN run[:(h % length(run))::BIGINT] || run[(h % length(run) + 2)::BIGINT:] ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(struct_pack(w := other, n := n), struct_pack(m := -n, w := other)) AS b
  FROM near GROUP BY word
), forms AS (
  SELECT word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 2 * words.n THEN b.w END AS form,
         CASE WHEN b.n >= 2 * words.n THEN b.n END AS form_n
  FROM words LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS root, 0 AS i FROM forms
  UNION ALL SELECT walk.word, forms.form, i + 1 FROM walk JOIN forms ON walk.root = forms.word AND forms.form IS NOT NULL
), ends AS (
  SELECT word, arg_max(root, i) AS root FROM walk GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""

LEAKS = rf"""
WITH items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS key, least(len(w), 10) AS size
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), docs AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents
), starts AS (
  SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM docs, (SELECT DISTINCT size FROM windows)
), found AS (
  SELECT row, i, s.size, item FROM starts s JOIN windows k ON s.size = k.size AND array_to_string(w[i:i + s.size - 1], ' ') = key
), hits AS (
  SELECT row, count(DISTINCT pos) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS pos FROM found) GROUP BY row
), named AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT row, item FROM found WHERE item IS NOT NULL) GROUP BY row
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row) LEFT JOIN named USING (row)
"""

PHRASES = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), sizes AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), grams AS (
  SELECT lang, k, w[i:i + k - 1] AS g, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) t(k))
  GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT c.lang, c.g, c.k, c.f AS a, x.f AS l, y.f AS r, n, cut, 1000::HUGEINT * c.f * n // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM grams WHERE k > 1) c
  JOIN grams x ON x.lang = c.lang AND x.g = c.g[:cut] JOIN grams y ON y.lang = c.lang AND y.g = c.g[cut + 1:]
  JOIN sizes ON sizes.lang = c.lang
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.g ORDER BY score, cut) = 1
), inner_of AS (
  SELECT lang, g[i:j] AS g, max(f) AS longer
  FROM (SELECT lang, g, k, f, i, unnest(range(i + 1, k + 1)) AS j FROM (SELECT *, unnest(range(1, k)) AS i FROM grams WHERE k > 2))
  WHERE j - i + 1 < k GROUP BY ALL
), ranked AS (
  SELECT c.*, array_to_string(c.g, ' ') AS phrase FROM cuts c
  LEFT JOIN inner_of o ON o.lang = c.lang AND o.g = c.g WHERE longer IS NULL OR 100 * longer < 100 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked QUALIFY rank <= 2000
"""

LLM_ORACLE = {
    "op1_exact_dedup": EXACT,
    "op4_topk_search": TOP,
    "op6_source_mix": MIX,
    "op8_chat_format": CHAT,
    "op11_spelling": SPELLING,
    "op12_decontamination": LEAKS,
    "op13_collocations": PHRASES,
}
