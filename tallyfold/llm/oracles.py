"""DuckDB SQL for the queries that SQL can express on whole tables: counts, windows and hashes."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc_table() -> list[int]:
    """What the eight steps of CRC-32 do to each byte."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def collocations_sql(least: int = 100, longest: int = 5, top: int = 2000) -> str:
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM pieces),
starts AS (
  SELECT lang, words, size, unnest(generate_series(1, len(words) - size + 1)) AS k
  FROM worded, (SELECT unnest(generate_series(1, {longest})) AS size) WHERE len(words) >= size),
counts AS (
  SELECT lang, size, array_to_string(words[k:k + size - 1], ' ') AS phrase, count(*) AS f FROM starts GROUP BY ALL),
totals AS (SELECT lang, sum(f)::HUGEINT AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS words, f FROM counts WHERE size > 1 AND f >= {least}),
part_starts AS (
  SELECT lang, f, words, part, unnest(generate_series(1, size - part + 1)) AS k
  FROM candidates, (SELECT unnest(generate_series(2, {longest - 1})) AS part) WHERE size > part),
above AS (
  SELECT lang, array_to_string(words[k:k + part - 1], ' ') AS phrase, max(f) AS longer_f FROM part_starts GROUP BY ALL),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN above p USING (lang, phrase) WHERE p.longer_f IS NULL OR p.longer_f < c.f),
cuts AS (
  SELECT lang, phrase, f, unnest(generate_series(1, size - 1)) AS k, words, size FROM kept),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.f AS a, cuts.k, lc.f AS l, rc.f AS r, n,
    (1000 * cuts.f::HUGEINT * n) // (lc.f::HUGEINT * rc.f::HUGEINT) AS score
  FROM cuts JOIN totals USING (lang)
  JOIN counts lc ON lc.lang = cuts.lang AND lc.phrase = array_to_string(words[1:k], ' ')
  JOIN counts rc ON rc.lang = cuts.lang AND rc.phrase = array_to_string(words[k + 1:cuts.size], ' ')),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM lowest QUALIFY rank <= {top}"""


def decontamination_sql(window: int = 10) -> str:
    words = f"""regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""
    return f"""
WITH docs AS (SELECT doc_id, {words} AS words FROM documents),
items AS (SELECT item_id, {words} AS words FROM benchmark),
sized AS (SELECT item_id, words, least({window}, len(words)) AS size FROM items WHERE len(words) > 0),
placed AS (SELECT item_id, size, words, unnest(generate_series(1, len(words) - size + 1)) AS k FROM sized),
windows AS (SELECT DISTINCT item_id, size, array_to_string(words[k:k + size - 1], ' ') AS phrase FROM placed),
sizes AS (SELECT DISTINCT size FROM windows),
starts AS (SELECT doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS k FROM docs, sizes WHERE len(words) >= size),
found AS (
  SELECT doc_id, k, size, item_id
  FROM (SELECT doc_id, k, size, array_to_string(words[k:k + size - 1], ' ') AS phrase FROM starts) JOIN windows USING (size, phrase)),
hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(generate_series(k, k + size - 1)) AS word FROM found) GROUP BY doc_id),
held AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)"""


def merkle_sql(arity: int = 3) -> str:
    def field(value):
        return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"

    plain = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    shortened = "replace(text, chr(10), '')"
    crc = f"""(SELECT list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
      lambda crc, c: xor(crc >> 8, list_extract({_crc_table()}::BIGINT[], (xor(crc, c) & 255) + 1))))"""
    return f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({plain} || {field("text")}) AS leaf,
    CASE WHEN xor({crc}, 4294967295) % 2 = 0 THEN sha256({plain} || {field(shortened)}) END AS changed
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
own(tree, level, place, n, h) AS (
  SELECT tree, 0, place, n, leaf FROM placed
  UNION ALL
  SELECT tree, level + 1, place // {arity}, (n + {arity - 1}) // {arity}, sha256(string_agg(h, '' ORDER BY place))
  FROM own WHERE n > 1 GROUP BY tree, level, place // {arity}, n),
upper_leaves AS (
  SELECT tree AS grp, h, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM own WHERE n = 1),
above(level, place, n, h) AS (
  SELECT 0, place, n, h FROM upper_leaves
  UNION ALL
  SELECT level + 1, place // {arity}, (n + {arity - 1}) // {arity}, sha256(string_agg(h, '' ORDER BY place))
  FROM above WHERE n > 1 GROUP BY level, place // {arity}, n),
nodes AS (
  SELECT tree, level, place, n, h FROM own UNION ALL SELECT '*', level, place, n, h FROM above),
ways AS (
  SELECT tree, level, place, n, coalesce(string_agg(h, '') OVER left_of, '') AS before, coalesce(string_agg(h, '') OVER right_of, '') AS after
  FROM nodes
  WINDOW left_of AS (PARTITION BY tree, level, place // {arity} ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    right_of AS (PARTITION BY tree, level, place // {arity} ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
walk(id, home, tree, level, place, proof, folded) AS (
  SELECT (tree, place), tree, tree, 0, place, '', coalesce(changed, leaf) FROM placed
  UNION ALL
  SELECT id, home, tree, level, place, proof, folded FROM (
    SELECT w.id, w.home, w.tree, w.level + 1 AS level, w.place // {arity} AS place, w.proof || s.before || s.after AS proof, sha256(s.before || w.folded || s.after) AS folded
    FROM walk w JOIN ways s ON s.tree = w.tree AND s.level = w.level AND s.place = w.place AND s.n > 1
    UNION ALL
    SELECT w.id, w.home, '*', 0, u.place, w.proof, w.folded
    FROM walk w JOIN ways s ON s.tree = w.tree AND s.level = w.level AND s.place = w.place AND s.n = 1 JOIN upper_leaves u ON u.grp = w.tree)),
done AS (SELECT walk.* FROM walk JOIN above ON walk.tree = '*' AND walk.level = above.level AND above.n = 1)
SELECT p.doc_id, p.leaf, u.h AS subroot, r.h AS root, sha256(d.proof) AS proof_sha256, d.folded AS folded_root, d.folded = r.h AS verified
FROM placed p JOIN done d ON d.id = (p.tree, p.place) JOIN upper_leaves u ON u.grp = p.tree, (SELECT h FROM above WHERE n = 1) r"""
