"""SQL for DuckDB of the queries that SQL can express."""

#: crc32 of the text x, bit by bit; DuckDB has no such function.
_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split({x}, ''), lambda ch: ord(ch)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda a, k: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"""

_FIELD = "coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')"
_REST = " || ".join(_FIELD.format(x=c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWERED = f"translate(text, '{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'}', '{'abcdefghijklmnopqrstuvwxyz'}')"

_MERKLE = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, sha256({_REST} || {_FIELD.format(x="text")}) AS leaf,
        CASE WHEN {_CRC32.format(x="doc_id::VARCHAR")} % 3 = 0 THEN sha256({_REST} || {_FIELD.format(x=_LOWERED)}) END AS other
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp
    FROM leaves
), nodes AS (
    SELECT grp, 0 AS level, pos AS k, n AS width, leaf AS h FROM placed
    UNION ALL
    SELECT grp, min(level) + 1, k // 8, (min(width) + 7) // 8, sha256(string_agg(h, '' ORDER BY k))
    FROM nodes WHERE width > 1 GROUP BY grp, k // 8
), subroots AS (
    SELECT grp, h, count(*) OVER () AS langs FROM nodes WHERE width = 1
), tops AS (
    SELECT 0 AS level, grp AS k, langs AS width, h FROM subroots
    UNION ALL
    SELECT min(level) + 1, k // 8, (min(width) + 7) // 8, sha256(string_agg(h, '' ORDER BY k))
    FROM tops WHERE width > 1 GROUP BY k // 8
), steps AS (
    -- every level of a row's proof, subroots after its language's own levels
    SELECT p.grp, p.pos, x.level, string_agg(x.h, '' ORDER BY x.k) FILTER (x.k < p.pos // (8 ** x.level)::BIGINT) AS before,
        string_agg(x.h, '' ORDER BY x.k) FILTER (x.k > p.pos // (8 ** x.level)::BIGINT) AS after
    FROM placed p JOIN nodes x ON x.grp = p.grp AND x.width > 1 AND x.k // 8 = p.pos // (8 ** (x.level + 1))::BIGINT
    GROUP BY ALL
    UNION ALL
    SELECT p.grp, p.pos, 1000 + x.level, string_agg(x.h, '' ORDER BY x.k) FILTER (x.k < p.grp // (8 ** x.level)::BIGINT),
        string_agg(x.h, '' ORDER BY x.k) FILTER (x.k > p.grp // (8 ** x.level)::BIGINT)
    FROM placed p JOIN tops x ON x.width > 1 AND x.k // 8 = p.grp // (8 ** (x.level + 1))::BIGINT
    GROUP BY ALL
), proofs AS (
    SELECT grp, pos, list({{'a': coalesce(before, ''), 'b': coalesce(after, '')}} ORDER BY level) AS path FROM steps GROUP BY grp, pos
), whole AS (
    SELECT p.*, coalesce(path, []) AS path, s.h AS subroot, (SELECT h FROM tops WHERE width = 1) AS root
    FROM placed p LEFT JOIN proofs q USING (grp, pos) JOIN subroots s USING (grp)
), done AS (
    SELECT *, list_reduce(list_prepend({{'a': '', 'b': coalesce(other, leaf)}}, path),
        lambda acc, step: {{'a': '', 'b': sha256(step.a || acc.b || step.b)}}).b AS folded_root FROM whole
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.a || s.b), '')) AS proof_sha256,
    folded_root, folded_root = root AS verified
FROM done
"""


def _round(k: int) -> str:
    """Distances to the codebooks of round k, first nearest entries, and the codebooks after it."""
    return f"""
, near{k} AS (
    SELECT x.row, x.part, arg_min(entry, (dist, entry)) AS entry, min(dist) AS dist FROM (
        SELECT x.row, x.part, b.entry, sum((x.v - b.v) ** 2)::BIGINT AS dist
        FROM comps x JOIN books{k} b USING (part, place) GROUP BY ALL
    ) x GROUP BY ALL
), books{k + 1} AS (
    SELECT part, entry, place, coalesce(m.v, b.v) AS v FROM books{k} b LEFT JOIN (
        SELECT part, entry, place, floor(sum(v)::DECIMAL(38, 0) / count(*))::BIGINT AS v
        FROM near{k} JOIN comps USING (row, part) GROUP BY ALL
    ) m USING (part, entry, place)
)"""


_CODES = f"""
WITH kept AS (
    SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0
), comps AS (
    SELECT row, (k - 1) // (len(embedding) // 16) AS part, (k - 1) % (len(embedding) // 16) AS place,
        floor(256 * embedding[k]::DOUBLE)::BIGINT AS v
    FROM kept, unnest(range(1, len(embedding) + 1)) AS u(k)
), books0 AS (
    SELECT part, row - 1 AS entry, place, v FROM comps WHERE row <= 64
){_round(0)}{_round(1)}{_round(2)}
, coded AS (
    SELECT row, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM near2 GROUP BY row
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, place)) FROM books2) AS codebooks_sha256
FROM coded JOIN kept USING (row)
"""

_LOWER_TEXT = _LOWERED.replace("(text", "(coalesce(text, '')")

#: RFC 4648 letters of the 32 groups of five bits of a sha1.
_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_reduce(list_transform(range(0, 5), lambda b: (strpos('0123456789abcdef', substr(h, 1 + (5 * i + b) // 4, 1)) - 1)
        // (2 ** (3 - (5 * i + b) % 4))::BIGINT % 2), lambda acc, bit: 2 * acc + bit), 1)), '')"""

_WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
first AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS original FROM p)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
    CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> original THEN original END AS refers_to
FROM first
"""

_TOKENS = "regexp_extract_all({text}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_LEAKS = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TOKENS.format(text=_LOWER_TEXT)} AS w FROM documents),
b AS (SELECT item_id, {_TOKENS.format(text=_LOWER_TEXT)} AS w FROM benchmark),
items AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, unnest([array_to_string(w[i : i + least(10, len(w)) - 1], ' ')
    for i in range(1, greatest(1, len(w) - 9) + 1)]) AS gram FROM b WHERE len(w) > 0),
places AS (SELECT row, n, unnest(range(1, len(w) - n + 2)) AS at_word, w FROM d, (SELECT DISTINCT n FROM items) WHERE len(w) >= n),
found AS (SELECT p.row, p.at_word, p.n, i.item_id FROM places p JOIN items i
    ON i.n = p.n AND i.gram = array_to_string(w[p.at_word : p.at_word + p.n - 1], ' ')),
hits AS (SELECT row, count(DISTINCT pos) AS n_hit FROM (SELECT row, unnest(range(at_word, at_word + n)) AS pos FROM found) GROUP BY row),
of_items AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM found) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (row) LEFT JOIN of_items USING (row)
"""

_JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER_TEXT}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[i : i + least(3, len(w)) - 1], ' ')
    for i in range(1, greatest(1, len(w) - 2) + 1)]) AS gram FROM d WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(y) AS component_id
FROM d JOIN reach ON x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id, n
"""

ORACLES: dict[str, str] = {
    "op6_warc": _WARC,
    "op8_decontamination": _LEAKS,
    "op9_ngram_jaccard": _JACCARD,
    "op11_merkle_manifest": _MERKLE,
    "op12_vector_codes": _CODES,
}
