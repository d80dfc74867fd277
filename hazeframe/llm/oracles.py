"""DuckDB SQL with the same rows as a corpus query, where SQL can express it.

The other queries need XXH64, tokenizers or fitted models, which SQL lacks, or a search
that it could only state as all pairs of windows and items; their tests compare with
plain versions.
"""

from __future__ import annotations

from hazeframe.llm.licenses import LEAST_DICE, TEMPLATES

# Base32 of a SHA-1: every five hex digits are four letters.
WARC = """WITH h AS (SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, sha1(t) AS s, max(page_id) OVER (PARTITION BY t) AS top
 FROM (SELECT page_id, coalesce(html, '') AS t FROM pages))
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
 ((CAST('0x' || substr(s, (i // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
 CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < top THEN top END AS refers_to FROM h"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[\\pL\\pN_]+')"


def _bigrams(words: str) -> str:
    return f"list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1])"


def licenses_sql() -> str:
    """Every run of words that begins and ends with a bigram of a template."""
    named = [(name, text) for name, texts in TEMPLATES.items() for text in texts]
    rows = ", ".join(f"({k}, {_quoted(n)}, {_quoted(t)})" for k, (n, t) in enumerate(named))
    ratio = LEAST_DICE / (2 - LEAST_DICE)
    return f"""WITH tw AS (SELECT k, license_id, {_words('t')} AS w FROM (VALUES {rows}) v(k, license_id, t)),
tg AS (SELECT k, license_id, unnest({_bigrams('w')}) AS g, len(w) - 1 AS n FROM tw WHERE len(w) > 1),
tn AS (SELECT k, license_id, g, n, count(*) AS times FROM tg GROUP BY ALL),
ln AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS line, {_words('ls[i]')} AS w
 FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents), unnest(range(1, len(ls) + 1)) u(i)),
wd AS (SELECT doc_id, line, unnest(w) AS w, unnest(range(len(w))) AS j FROM ln),
sq AS (SELECT doc_id, line, w, row_number() OVER o AS i, lead(w) OVER o AS w2, lead(line) OVER o AS line2 FROM wd WINDOW o AS (PARTITION BY doc_id ORDER BY line, j)),
an AS (SELECT doc_id, k, license_id, n, times, i, line, line2, g FROM sq JOIN tn ON g = w || ' ' || w2),
ok AS (SELECT doc_id, k FROM an GROUP BY doc_id, k, n HAVING count(*) >= n * {ratio} - 0.001),
ac AS (SELECT an.* FROM an JOIN ok ON an.doc_id = ok.doc_id AND an.k = ok.k),
rn AS (SELECT a.doc_id, a.k, a.license_id, a.n, a.i AS lo, b.i AS hi, a.line, b.line2 FROM ac a JOIN ac b
 ON a.doc_id = b.doc_id AND a.k = b.k AND b.i BETWEEN a.i AND a.i + a.n / {ratio} + 0.001 - 1),
cm AS (SELECT rn.*, c.g, least(count(*), c.times) AS shared FROM rn JOIN ac c ON c.doc_id = rn.doc_id AND c.k = rn.k AND c.i BETWEEN lo AND hi
 GROUP BY rn.doc_id, rn.k, rn.license_id, rn.n, lo, hi, rn.line, rn.line2, c.g, c.times),
dv AS (SELECT doc_id, license_id, lo, hi, line, line2, 2 * sum(shared) / CAST(hi - lo + 1 + n AS DOUBLE) AS dice FROM cm GROUP BY doc_id, k, license_id, n, lo, hi, line, line2)
SELECT doc_id, license_id, line, CAST(line2 - line + 1 AS INTEGER) AS lines, dice FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, license_id ORDER BY dice DESC, hi - lo, lo) AS rn
 FROM dv WHERE dice >= {LEAST_DICE}) WHERE rn = 1"""

# What a source's words are taken from follows from its target: the first words of its
# documents in the order of their MD5, round after round.
MIXING = """WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
  md5(coalesce(CAST(doc_id AS VARCHAR), '-') || '/' || coalesce(text, '')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS HUGEINT) AS s, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w
 FROM d GROUP BY source),
o AS (SELECT *, sum(s) OVER () AS total, coalesce(sum(s) OVER b, 0) AS filled, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS words
 FROM s WINDOW b AS (ORDER BY s * (6 // w), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, 4 * s * words <= w * (3 * total - 4 * filled) AS is_full FROM o),
t AS (SELECT source, s, CASE WHEN is_full THEN CAST(2 * s AS DOUBLE)
 ELSE w * CAST(3 * total - 4 * coalesce(sum(s) FILTER (is_full) OVER (), 0) AS DOUBLE) / CAST(2 * sum(w) FILTER (NOT is_full) OVER () AS DOUBLE) END AS target FROM f),
p AS (SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target, CAST(floor(target) AS BIGINT) AS t,
 CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a
 FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
 greatest(0, least(a + size, t) - a) + greatest(0, least(a + source_size + size, t) - a - source_size) AS taken FROM p"""

NEGATIVES = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
 FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
 FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
 FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""

_CRC = """crc AS (SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce(list_prepend(CAST(b AS UBIGINT), CAST(range(8) AS UBIGINT[])),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(b)))"""


def repair_sql() -> str:
    """Costs to go row by row from the end, then the edits from the start."""
    far = 1_000_000_000

    def edits(s: int, keep: dict[str, int]) -> str:
        """Cheapest way over row i from state s without an insert before it; v holds the costs to go behind it."""
        nxt = 3 if s == 2 else 2
        kept = " ".join(f"WHEN '{c}' THEN x + v[{k + 1}]" for c, k in keep.items())
        return f"least(2 + v[{s + 1}], CASE WHEN gone THEN {far} ELSE least(1 + x + v[{nxt + 1}], CASE init {kept} ELSE {far} END) END)"

    keeps = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    costs = ", ".join(f"{edits(s, k)} AS e{s}" for s, k in enumerate(keeps))
    return f"""WITH RECURSIVE {_CRC},
r AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '') AS k FROM conversations),
h AS (SELECT r.*, xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(k, lambda x: CAST(ascii(x) AS UBIGINT))),
  lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INTEGER) + 1])), 4294967295) % 20 AS h FROM r, crc),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, c
 FROM h, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) u(c) WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), c) AS i,
  rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core FROM d),
f AS (SELECT *, core = '' AS blank, core <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
  left(role, 1) AS init, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier FROM o),
g AS (SELECT *, blank OR duplicate AS gone, NOT blank AND NOT duplicate AND NOT contains('.!?', right(core, 1)) AS truncated FROM f),
n AS (SELECT conv_id, max(i) AS n FROM g GROUP BY conv_id),
b AS (SELECT conv_id, n + 1 AS i, [0, 10, 5, 0] AS w FROM n UNION ALL
 SELECT conv_id, i, [least(e0, 5 + e2, 10 + e3), least(e1, 5 + e2, 10 + e3), least(e2, 5 + e3), least(e3, 5 + e2)]
 FROM (SELECT conv_id, i, {costs} FROM (SELECT g.*, b.w AS v, CASE WHEN truncated THEN 5 ELSE 0 END AS x
  FROM b JOIN g ON g.conv_id IS NOT DISTINCT FROM b.conv_id AND g.i = b.i - 1))),
a AS (SELECT conv_id, CAST(1 AS BIGINT) AS i, 0 AS s, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM n UNION ALL
 SELECT conv_id, CASE WHEN e = 'I' THEN i ELSE i + 1 END, CASE e WHEN 'D' THEN s WHEN 'K' THEN kept ELSE nxt END, audit || e,
  CASE e WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
   ELSE list_append(lines, CASE s WHEN 2 THEN 'assistant:' ELSE 'user:' END || CASE e WHEN 'R' THEN text ELSE '' END) END
 FROM (SELECT *, CASE WHEN i > n OR 2 + v[s + 1] <> w[s + 1] THEN CASE WHEN 5 + w[nxt + 1] = w[s + 1] THEN 'I'
   WHEN NOT gone AND kept IS NOT NULL AND x + v[kept + 1] = w[s + 1] THEN 'K' ELSE 'R' END ELSE 'D' END AS e
  FROM (SELECT a.*, n.n, bi.w, bj.w AS v, g.role, g.text, g.gone, CASE WHEN g.truncated THEN 5 ELSE 0 END AS x, CASE a.s WHEN 2 THEN 3 ELSE 2 END AS nxt,
    CASE WHEN a.s = 0 AND g.init = 's' THEN 1 WHEN a.s <> 2 AND g.init = 'u' THEN 2 WHEN a.s = 2 AND g.init = 'a' THEN 3 END AS kept
   FROM a JOIN n ON n.conv_id IS NOT DISTINCT FROM a.conv_id JOIN b bi ON bi.conv_id IS NOT DISTINCT FROM a.conv_id AND bi.i = a.i
   LEFT JOIN b bj ON bj.conv_id IS NOT DISTINCT FROM a.conv_id AND bj.i = a.i + 1
   LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM a.conv_id AND g.i = a.i
   WHERE a.i <= n.n OR bi.w[a.s + 1] > 0))),
done AS (SELECT a.conv_id, audit, sha256(array_to_string(lines, chr(10))) AS repaired_sha256
 FROM a JOIN n ON n.conv_id IS NOT DISTINCT FROM a.conv_id AND a.i = n.n + 1 AND a.s IN (0, 3)),
counts AS (SELECT g.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
  count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
  count(*) FILTER (i > 1 AND earlier || init NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY g.conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
 coalesce(illegal, 0) AS illegal, CAST(coalesce(b.w[1], 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM e.conv_id AND b.i = 1"""
