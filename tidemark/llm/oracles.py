"""The queries that SQL can express, as DuckDB SQL on the same tables, worked out on other paths where there are any."""

from __future__ import annotations

from tidemark.llm.common import UPPER
from tidemark.llm.katz import SEEN, TURING
from tidemark.llm.license_texts import PHRASES, TEMPLATES
from tidemark.llm.quality import COMPONENTS, DIM
from tidemark.llm.spelling import DELETED, FACTOR, LEAST_COUNT, LEAST_LENGTH

GAP = r"[ \t-\r]+"


def _mixing(rounds: int = 80, temperature: float = 0.7, budget: float = 0.9, seed: int = 7) -> str:
    dims = ("source", "lang", "topic")
    parts = [f"""docs AS MATERIALIZED (
      SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
        len(list_filter(regexp_split_to_array(coalesce(text, ''), '{GAP}'), lambda w: w <> '')) AS n_tokens
      FROM documents),
    kinds AS MATERIALIZED (
      SELECT doc_id, source, lang, n_tokens, CASE
        WHEN (length(text) - length(translate(text, '#*$%&|<>', ''))) * 50 > length(text) THEN 'marked'
        WHEN n_tokens < 8 * (length(text) - length(replace(text, chr(10), '')) + 1) THEN 'lines'
        WHEN n_tokens < 150 THEN 'short' ELSE 'long' END AS topic FROM docs),
    cells AS MATERIALIZED (
      SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM kinds WHERE n_tokens > 0 GROUP BY ALL)"""]
    parts += [f"""share_{d} AS MATERIALIZED (
      SELECT {d}, pow(sum(tokens), {temperature}) / sum(pow(sum(tokens), {temperature})) OVER () AS share FROM cells GROUP BY {d})"""
              for d in dims]
    parts.append("raked_0 AS MATERIALIZED (SELECT *, tokens / sum(tokens) OVER () AS weight FROM cells)")
    for i in range(rounds * 3):
        d = dims[i % 3]
        parts.append(f"""raked_{i + 1} AS MATERIALIZED (
      SELECT source, lang, topic, tokens, weight * share / sum(weight) OVER (PARTITION BY {d}) AS weight
      FROM raked_{i} JOIN share_{d} USING ({d}))""")
    last = f"raked_{rounds * 3}"
    parts.append("factor_0 AS MATERIALIZED (SELECT 0.0::DOUBLE AS f)")
    for i in range(rounds):
        parts.append(f"""factor_{i + 1} AS MATERIALIZED (
      SELECT greatest(f, coalesce(({budget} * sum(tokens) - sum(CASE WHEN weight / tokens * f >= 1 THEN tokens ELSE 0 END))
        / nullif(sum(CASE WHEN weight / tokens * f >= 1 THEN 0 ELSE weight END), 0), f)) AS f
      FROM {last}, factor_{i} GROUP BY f)""")
    return f"""WITH {", ".join(parts)}
    SELECT doc_id, k.source, k.lang, k.topic, n_tokens::BIGINT AS n_tokens, round(coalesce(weight, 0), 9) AS weight,
      round(p, 9) AS probability,
      ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496 < p AS sampled
    FROM (SELECT k.*, weight, CASE WHEN weight IS NULL THEN 0 ELSE least(1.0, weight / tokens * f) END AS p FROM kinds k
      LEFT JOIN (SELECT * FROM {last}, factor_{rounds}) USING (source, lang, topic)) k"""


def _archive() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return f"""WITH p AS (
      SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
    q AS (SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM p)
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
      array_to_string(list_transform(range(32), lambda i: substr('{letters}',
        ((('0x' || substr(hex, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (5 * (3 - i % 4))) & 31)::INT + 1, 1)), '') AS payload_digest,
      CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
    FROM q"""


def _neighbours(k: int = 10) -> str:
    """The exact neighbours: the codes' recall is below 1 if a row differs."""
    return f"""WITH v AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    u AS (SELECT * FROM v WHERE len(e) = (SELECT len(e) FROM v GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)),
    d AS (
      SELECT q.vec_id AS query_id, q.rid AS q_rid, u.vec_id, u.rid,
        sqrt(list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - u.e[i]) * (q.e[i] - u.e[i])), lambda x, y: x + y)) AS score
      FROM u q JOIN u ON u.rid <> q.rid WHERE q.vec_id % 100 = 0)
    SELECT query_id, rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id, q_rid ORDER BY score, vec_id, rid)::INT AS rank FROM d) WHERE rank <= {k}"""


def _quality(support: float = 0.75, steps: int = 3, min_docs: int = 60, cutoff: float = 200.0) -> str:
    floors = [float(v) for v in COMPONENTS.values()]
    normal = DIM * (1 - 2 / (9 * DIM)) ** 3
    lower = [(i, j) for i in range(DIM) for j in range(i + 1)]
    parts = [rf"""docs AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS lang, coalesce('=' || source, '') AS source,
        coalesce(text, '') AS text FROM documents),
    words AS MATERIALIZED (
      SELECT rid, list_filter(regexp_split_to_array(text, '{GAP}'), lambda w: w <> '') AS w FROM docs),
    grams AS (
      SELECT rid, unnest(range(len(w) - 7)) AS p, array_to_string(w[p + 1:p + 8], ' ') AS g FROM words WHERE len(w) > 7),
    again AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS n FROM grams) WHERE n > 1),
    repeats AS (SELECT rid, count(DISTINCT p + o) AS n FROM again, range(8) AS r(o) GROUP BY rid),
    lines AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS l FROM docs),
    base AS MATERIALIZED (
      SELECT d.rid, doc_id, lang, source, len(w) AS n_words, length(regexp_replace(text, '{GAP}', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(list_distinct(w)) AS n_distinct,
        length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals
      FROM docs d JOIN words USING (rid) JOIN lines USING (rid) LEFT JOIN repeats r USING (rid)),
    stats AS MATERIALIZED (
      SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        round(ln(1.0::DOUBLE + n_words) * 256)::BIGINT AS x0, round(ln((word_chars + 1)::DOUBLE / (n_words + 1)) * 256)::BIGINT AS x1,
        round(ln(1 + 100 * n_symbols / (word_chars + 1)::DOUBLE) * 256)::BIGINT AS x2,
        round(ln((n_words + 1)::DOUBLE / (n_distinct + 1)) * 256)::BIGINT AS x3,
        round(ln(1 + 100 * n_repeat_words / (n_words + 1)::DOUBLE) * 256)::BIGINT AS x4,
        round(ln(1 + 100 * n_capitals / (word_chars + 1)::DOUBLE) * 256)::BIGINT AS x5
      FROM base),
    counted AS (SELECT lang, source, count(*) AS n FROM stats WHERE NOT base_failed GROUP BY ALL),
    cells AS MATERIALIZED (
      SELECT lang, source, CASE WHEN n < {min_docs} AND sum(CASE WHEN n < {min_docs} THEN n END) OVER (PARTITION BY lang) < {min_docs}
        THEN '*' ELSE lang END || chr(31) || CASE WHEN n >= {min_docs} THEN source ELSE '*' END AS cell FROM counted),
    vectors AS MATERIALIZED (
      SELECT cell, {", ".join(f"x{i}" for i in range(DIM))} FROM stats JOIN cells USING (lang, source) WHERE NOT base_failed),
    e0 AS MATERIALIZED (
      SELECT cell, {", ".join(f"quantile_disc(x{i}, 0.5)::DOUBLE AS m{i}" for i in range(DIM))},
        {", ".join(f"greatest((quantile_disc(x{i}, 0.75) - quantile_disc(x{i}, 0.25)) / 1.349::DOUBLE, {floors[i]}::DOUBLE) AS l{i}_{j}"
                   if i == j else f"0.0::DOUBLE AS l{i}_{j}" for i, j in lower)}
      FROM vectors GROUP BY cell)"""]

    def distance(rows: str, estimate: str, keep: str) -> str:
        inner = f"SELECT v.*, {', '.join([*(f'm{i}' for i in range(DIM)), *(f'l{i}_{j}' for i, j in lower)])} FROM {rows} v LEFT JOIN {estimate} e USING (cell)"
        for i in range(DIM):
            rest = f"x{i} - m{i}" + "".join(f" - l{i}_{k} * y{k}" for k in range(i))
            inner = f"SELECT *, ({rest}) / l{i}_{i} AS y{i} FROM ({inner})"
        return f"SELECT {keep}, {' + '.join(f'y{i} * y{i}' for i in range(DIM))} AS d2 FROM ({inner})"

    xs = ", ".join(f"x{i}" for i in range(DIM))
    for s in range(steps):
        parts.append(f"""near{s} AS MATERIALIZED (
      SELECT cell, {xs}, floor(32 * ln(1 + 64 * d2)) AS b FROM ({distance("vectors", f"e{s}", "cell, " + xs)}))""")
        parts.append(f"limit{s} AS (SELECT cell, quantile_disc(b, {support}) AS most FROM near{s} GROUP BY cell)")
        moments = f"""SELECT cell, {", ".join(f"sum(x{i})::DOUBLE / count(*) AS m{i}" for i in range(DIM))},
          {", ".join(f"sum(x{j}::HUGEINT * x{i})::DOUBLE / count(*) - sum(x{j})::DOUBLE / count(*) * sum(x{i})::DOUBLE / count(*)"
                     f" + {floors[i] ** 2 if i == j else 0.0}::DOUBLE AS c{i}_{j}" for i, j in lower)}
          FROM near{s} JOIN limit{s} USING (cell) WHERE b <= most GROUP BY cell"""
        for j in range(DIM):
            for i in range(j, DIM):
                rest = f"c{i}_{j}" + "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j))
                value = f"sqrt(greatest({rest}, 1e-6::DOUBLE))" if i == j else f"({rest}) / l{j}_{j}"
                moments = f"SELECT *, {value} AS l{i}_{j} FROM ({moments})"
        parts.append(f"e{s + 1} AS MATERIALIZED ({moments})")
    parts.append(f"""middle AS MATERIALIZED (
      SELECT cell, greatest((exp((quantile_disc(floor(32 * ln(1 + 64 * d2)), 0.5) + 1) / 32) - 1) / 64 / {normal!r}::DOUBLE, 1e-3) AS scale
      FROM ({distance("vectors", f"e{steps}", "cell")}) GROUP BY cell),
    judged AS (
      SELECT j.*, d2 / scale AS distance
      FROM ({distance("(SELECT s.*, cell FROM stats s LEFT JOIN cells USING (lang, source))", f"e{steps}", "v.*").replace("SELECT v.*, y0", "SELECT *, y0")}) j
      LEFT JOIN middle USING (cell))""")
    return f"""WITH {", ".join(parts)}
    SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
      n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, round(distance, 6) AS distance,
      NOT base_failed AND coalesce(distance <= {cutoff}, true) AS kept
    FROM judged"""


def _licenses(gap: int = 8, drift: int = 8, least: float = 0.7) -> str:
    word_gap = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    rows = [(label, text, "true") for text, label in PHRASES.items()] + [(label, text, "false") for label, text in TEMPLATES]
    values = ", ".join("({}, '{}', '{}', {})".format(i, label, text.replace("'", "''"), phrase) for i, (label, text, phrase) in enumerate(rows))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def words(text: str) -> str:
        return f"list_filter(regexp_split_to_array(translate({text}, '{upper}', '{upper.lower()}'), '{word_gap}'), lambda w: w <> '')"

    return rf"""WITH docs AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, doc_id, {words("coalesce(text, '')")} AS w FROM documents),
    texts AS MATERIALIZED (
      SELECT i, label, phrase, w, CASE WHEN phrase OR len(w) < 5 THEN 2 ELSE 4 END AS k
      FROM (SELECT i, label, phrase, {words("text")} AS w FROM (VALUES {values}) AS t(i, label, text, phrase))),
    grams AS MATERIALIZED (
      SELECT i, label, phrase, k, len(w) - k + 1 AS n_grams, unnest(range(len(w) - k + 1)) AS tp, array_to_string(w[tp + 1:tp + k], ' ') AS g FROM texts),
    places AS MATERIALIZED (SELECT rid, w, unnest(range(len(w))) AS p FROM docs),
    near AS MATERIALIZED (SELECT rid, p, array_to_string(w[p + 1:p + 2], ' ') AS g2, array_to_string(w[p + 1:p + 4], ' ') AS g4 FROM places),
    votes AS MATERIALIZED (
      SELECT rid, i, label, phrase, k, n_grams, tp, p FROM near JOIN grams ON g = g2 AND k = 2
      UNION ALL SELECT rid, i, label, phrase, k, n_grams, tp, p FROM near JOIN grams ON g = g4 AND k = 4),
    diagonals AS MATERIALIZED (
      SELECT rid, i, label, phrase, k, n_grams, p - tp AS o, min(p) AS a, max(p) AS b, count(DISTINCT tp) AS n FROM votes GROUP BY ALL),
    base AS (SELECT rid, label, o AS start FROM diagonals WHERE phrase AND n = n_grams),
    runs AS (
      SELECT *, sum(new) OVER (PARTITION BY rid, i ORDER BY a, o) AS run FROM (
        SELECT *, CASE WHEN a > before + k + {gap} OR abs(o - o_before) > {drift} OR before IS NULL THEN 1 ELSE 0 END AS new FROM (
          SELECT *, max(b) OVER (PARTITION BY rid, i ORDER BY a, o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
            lag(o) OVER (PARTITION BY rid, i ORDER BY a, o) AS o_before FROM diagonals WHERE NOT phrase))),
    spans AS (
      SELECT r.rid, r.label, min(r.n_grams) AS n_grams, min(r.k) AS k, min(a) AS start, max(b) + min(r.k) AS stop, count(DISTINCT tp) AS n
      FROM runs r JOIN votes v ON v.rid = r.rid AND v.i = r.i AND v.p - v.tp = r.o GROUP BY r.rid, r.i, r.label, run
      UNION ALL
      SELECT rid, label, min(n_grams), min(k), min(p), max(p) + min(k), count(DISTINCT tp)
      FROM (SELECT *, unnest([0, 1]) AS earlier FROM votes WHERE NOT phrase)
      GROUP BY rid, i, label, floor((p - tp) / greatest({drift}, n_grams // 3)) - earlier),
    good AS (
      SELECT rid, label, n / n_grams AS coverage FROM spans WHERE n / n_grams >= {least} AND stop - start <= 2 * (n_grams + k - 1)),
    labelled AS (SELECT rid, label, 1.0::DOUBLE AS coverage FROM base UNION ALL SELECT * FROM good)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
      coalesce(b.l, '') AS base_labels, coalesce(m.l, '') AS labels, coalesce(m.score, 0.0)::DOUBLE AS score
    FROM docs
    LEFT JOIN (SELECT rid, count(*) AS n, min(start) AS first_word, max(start) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM base GROUP BY rid) b USING (rid)
    LEFT JOIN (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS l, max(coverage) AS score FROM labelled GROUP BY rid) m USING (rid)"""


def _katz() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    less = f"""c * CASE WHEN c <= {TURING} AND coalesce(turing[c::INT], 0) > 0 AND turing[c::INT] < 1 THEN turing[c::INT]
        ELSE pow(1 + 1 / c::DOUBLE, power) END"""

    def discount(counts: str) -> str:
        """Turing's factors for small counts, and the power of the fitted line."""
        return f"""SELECT list_transform(range(1, {TURING + 1}), lambda r: (r + 1) * coalesce(n[r + 1], 0)::DOUBLE / (r * n[r])) AS turing,
          least(coalesce(slope, -2) + 1, -0.05::DOUBLE) AS power
        FROM (SELECT map_from_entries(list((c, k))) AS n, CASE WHEN count(*) > 1 THEN regr_slope(ln(k::DOUBLE), ln(c::DOUBLE)) END AS slope
          FROM (SELECT c, count(*) AS k FROM {counts} WHERE c < {SEEN} GROUP BY c))"""

    return f"""WITH polynomial AS MATERIALIZED (
      SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda a, k: xor(a >> 1, 3988292384 * (a & 1)))) AS t),
    docs AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, doc_id, list_append(list_filter(regexp_split_to_array(
          translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{GAP}'), lambda w: w <> ''), '') AS words,
        xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(list_filter(string_split(coalesce(doc_id::VARCHAR, ''), ''),
          lambda x: x <> ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 7 = 2 AS held
      FROM documents, polynomial),
    tokens AS MATERIALIZED (
      SELECT rid, held, w, coalesce(lag(w) OVER (PARTITION BY rid ORDER BY p), ' begin') AS h
      FROM (SELECT rid, held, unnest(words) AS w, unnest(range(len(words))) AS p FROM docs)),
    one AS MATERIALIZED (SELECT w, count(*) AS c FROM tokens WHERE NOT held GROUP BY w),
    two AS MATERIALIZED (SELECT h, w, count(*) AS c FROM tokens WHERE NOT held GROUP BY h, w),
    size AS MATERIALIZED (SELECT sum(c)::BIGINT AS n, count(*) AS v FROM one),
    d1 AS MATERIALIZED ({discount("one")}), d2 AS MATERIALIZED ({discount("two")}),
    p1 AS MATERIALIZED (SELECT w, c, {less} / n AS p FROM one, d1, size),
    unknown AS MATERIALIZED (SELECT greatest(1 - coalesce(sum(p), 0), 1e-12) AS p FROM p1),
    p2 AS MATERIALIZED (
      SELECT h, w, {less} / sum(c) OVER (PARTITION BY h) AS p FROM two, d2),
    weights AS MATERIALIZED (
      SELECT h, (1 - sum(p2.p)) / (1 - sum(p1.p)) AS a FROM p2 JOIN p1 USING (w) GROUP BY h),
    scored AS (
      SELECT rid, count(*) AS n_tokens, count(p1.c) AS n_known, sum(log10((coalesce(p1.c, 0) + 1)::DOUBLE / (n + v + 1))) AS base_score,
        sum(CASE WHEN p2.p IS NOT NULL THEN log10(p2.p) ELSE log10(coalesce(p1.p, u.p)) + coalesce(log10(a), 0) END) AS score
      FROM tokens CROSS JOIN size CROSS JOIN unknown u LEFT JOIN p1 ON p1.w = tokens.w
        LEFT JOIN p2 ON p2.h = tokens.h AND p2.w = tokens.w LEFT JOIN weights ON weights.h = tokens.h
      GROUP BY rid)
    SELECT doc_id, held AS held_out, n_tokens, n_known, n AS train_tokens, round(base_score, 6) AS base_score, round(score, 6) AS score
    FROM docs JOIN scored USING (rid), size"""


def _repeats(length: int = 200) -> str:
    return f"""WITH docs AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
    starts AS (
      SELECT rid, i, md5(substr(x, 2 * i + 1, {2 * length})) AS g
      FROM (SELECT rid, x, unnest(range(n - {length - 1})) AS i FROM docs WHERE n >= {length})),
    again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY g) AS k FROM starts) WHERE k > 1),
    marks AS (
      SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + {length} THEN 0 ELSE 1 END AS new FROM again),
    runs AS MATERIALIZED (
      SELECT rid, min(i) AS a, max(i) + {length} AS b
      FROM (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS r FROM marks) GROUP BY rid, r),
    pieces AS (
      SELECT rid, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS a, a AS b FROM runs
      UNION ALL SELECT rid, max(b), NULL FROM runs GROUP BY rid),
    kept AS (
      SELECT rid, string_agg(substr(x, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS k FROM pieces JOIN docs USING (rid) GROUP BY rid)
    SELECT doc_id, n::BIGINT AS n_bytes, coalesce(r.removed, 0)::BIGINT AS n_removed, coalesce(r.spans, 0)::BIGINT AS n_spans,
      sha256(unhex(coalesce(k, x))) AS kept_sha256
    FROM docs LEFT JOIN kept USING (rid)
    LEFT JOIN (SELECT rid, sum(b - a) AS removed, count(*) AS spans FROM runs GROUP BY rid) r USING (rid)"""


def _page_text() -> str:
    """The pages of the given tables hold one article each, and only a few tags and character references."""
    references = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "''", "&#x27;": "''", "&amp;": "&"}
    decoded = "b"
    for name, char in references.items():
        decoded = f"replace({decoded}, '{name}', '{char}')"
    return f"""WITH p AS (
      SELECT row_number() OVER () AS rid, page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS a FROM pages),
    q AS (
      SELECT rid, unnest(b) AS b, generate_subscripts(b, 1) AS i
      FROM (SELECT rid, regexp_split_to_array(regexp_replace(replace(a, '<br>', ' '), '</?[bi]>', '', 'g'), '<[^>]*>') AS b FROM p)),
    t AS (SELECT rid, i, trim(regexp_replace({decoded}, '[ \t\r\n]+', ' ', 'g')) AS b FROM q),
    j AS (SELECT rid, string_agg(b, chr(10) ORDER BY i) AS text FROM t WHERE b <> '' GROUP BY rid)
    SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars FROM p LEFT JOIN j USING (rid)"""


def _spelling() -> str:
    """Near words by a join on what is left when one character of each is taken out."""
    upper = UPPER
    return f"""WITH RECURSIVE polynomial AS MATERIALIZED (
      SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda a, k: xor(a >> 1, 3988292384 * (a & 1)))) AS t),
    runs AS MATERIALIZED (
      SELECT coalesce(doc_id::VARCHAR, '') AS k, w, count(*) AS c FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[A-Za-zÀ-ÿ]+')) AS w
        FROM documents) WHERE length(w) >= {LEAST_LENGTH} GROUP BY ALL),
    hashed AS MATERIALIZED (
      SELECT w, c, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(k || ':' || w, ''),
        lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END))),
        lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8))) AS h FROM runs, polynomial),
    words AS MATERIALIZED (
      SELECT w AS word, sum(c)::BIGINT AS n FROM (
        SELECT c, CASE WHEN h % {DELETED} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w FROM hashed)
      WHERE length(w) >= {LEAST_LENGTH} GROUP BY w HAVING sum(c) >= {LEAST_COUNT}),
    less AS MATERIALIZED (
      SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
    pairs AS MATERIALIZED (
      SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT l.word, l.n, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
      UNION SELECT w.word, w.n, l.word, l.n FROM less l JOIN words w ON l.rest = w.word),
    best AS (
      SELECT word, n_near, other, other_n FROM (
        SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
          row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS r FROM pairs) WHERE r = 1),
    forms AS MATERIALIZED (
      SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {FACTOR} * w.n THEN other END AS form,
        CASE WHEN other_n >= {FACTOR} * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best b USING (word)),
    chain AS (
      SELECT word, word AS root FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
    roots AS (SELECT word, arg_max(root, n) AS root FROM chain JOIN (SELECT word AS root, n FROM words) USING (root) GROUP BY word)
    SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n FROM forms JOIN roots USING (word)"""


ORACLES = {"op1_quality": _quality(), "op2_licenses": _licenses(), "op3_mixing": _mixing(),
           "op4_neighbours": _neighbours(), "op5_warc": _archive(),
           "op6_repeats": _repeats(), "op7_katz": _katz(),
           "op12_page_text": _page_text(), "op13_spelling": _spelling()}
