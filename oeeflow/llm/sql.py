"""DuckDB SQL of the queries that SQL can express, built from the same parameters."""

from __future__ import annotations

from oeeflow.llm.licenses import LOWER, TEMPLATES, UPPER, template_bigrams, template_words
from oeeflow.llm.mixing import BINS, BUCKET_BITS
from oeeflow.llm.quality import STOP_WORDS, THRESHOLDS

_W = r"[^\x20\x09-\x0D]+"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def quality_counts(docs: str = "documents") -> str:
    stops = ", ".join(_text(v) for v in sorted({v for w in STOP_WORDS for v in (w, w.capitalize(), w.upper())}))
    return f"""
    WITH base AS (SELECT row_number() OVER () AS rid, doc_id, coalesce("text", '') AS t FROM {docs}),
    w AS (SELECT rid, regexp_extract_all(t, '{_W}') AS ws FROM base),
    tok AS (SELECT rid, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
    win AS (SELECT rid, i, list_aggregate(ws[i:i + 4], 'string_agg', ' ') AS g
            FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
    dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
    cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM dup) GROUP BY rid),
    ln AS (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM base),
    lines AS (SELECT rid, count(*) AS n, count(*) - count(DISTINCT l) AS d FROM ln
              WHERE regexp_matches(l, '{_W}') GROUP BY rid),
    st AS (SELECT rid, count(*) AS n FROM tok WHERE x IN ({stops}) GROUP BY rid)
    SELECT b.rid, b.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words,
           CAST(coalesce(length(list_aggregate(w.ws, 'string_agg', '')), 0) AS BIGINT) AS word_chars,
           CAST(length(b.t) - length(regexp_replace(b.t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(lines.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(lines.d, 0) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(st.n, 0) AS BIGINT) AS n_stop_words, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
    FROM base b JOIN w USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN st USING (rid) LEFT JOIN cov USING (rid)"""


def quality() -> str:
    rules = []
    for _, ratio, least, most, from_words in THRESHOLDS:
        top, _, bottom = ratio.partition(" / ")
        value = f"CAST({top} AS DOUBLE)" + (f" / nullif(CAST({bottom} AS DOUBLE), 0)" if bottom else "")
        inside = [f"{value} {sign} {float(bound)}" for sign, bound in ((">=", least), ("<=", most)) if bound is not None]
        rules.append(f"(coalesce({' AND '.join(inside)}, true) OR n_words < {from_words})")
    failed = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"
    return (f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed, "
            f"(NOT {failed} AND {' AND '.join(rules)}) AS kept FROM ({quality_counts()})")


def mixing() -> str:
    def finish(k):
        return f"((CAST(source_size AS DOUBLE) * {k} + cum) / CASE WHEN target > 0 THEN target END)"

    def bins(f):
        return f"CAST(CASE WHEN {f} < 4 THEN floor({f} * {BINS}) ELSE floor((log2(greatest({f}, 4.0)) + 2) * {BINS}) END AS BIGINT)"
    passes = " UNION ALL ".join(f"SELECT id, skey, size, {k} AS k, {finish(k)} AS finish FROM q WHERE size > 0" for k in range(3))
    return f"""
    WITH r AS (SELECT doc_id AS id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
                      CAST(len(regexp_extract_all(coalesce("text", ''), '{_W}')) AS BIGINT) AS size,
                      ('0x' || substring(md5('mix' || coalesce(':' || CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS u FROM documents),
    s AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size FROM r GROUP BY skey),
    s2 AS (SELECT *, (row_number() OVER (ORDER BY skey) - 1) % 3 + 1 AS weight, sum(source_size) OVER () AS budget FROM s),
    s3 AS (SELECT *, source_size * 3 AS cap, CAST(source_size * 3 AS DOUBLE) / weight AS full_at FROM s2),
    s4 AS (SELECT *, CAST(budget - coalesce(sum(cap) OVER (ORDER BY full_at, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
                  / sum(weight) OVER (ORDER BY full_at, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM s3),
    lv AS (SELECT arg_min(lvl, (full_at, skey)) AS lvl FROM s4 WHERE full_at > lvl),
    t AS (SELECT skey, source_size, coalesce(least(CAST(cap AS DOUBLE), lv.lvl * weight), CAST(cap AS DOUBLE)) AS target
          FROM s4 LEFT JOIN lv ON true),
    q AS (SELECT r.*, t.source_size, t.target,
                 CAST(sum(size) OVER (PARTITION BY r.skey ORDER BY u >> {60 - BUCKET_BITS}, u, id NULLS FIRST, size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum
          FROM r JOIN t ON r.skey = t.skey),
    p AS (SELECT *, sum(size) OVER (ORDER BY {bins('finish')}, finish, skey, id NULLS FIRST, k, size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM ({passes})),
    tk AS (SELECT id, skey, size, sum(size) AS taken FROM p WHERE used <= (SELECT max(budget) FROM s2) GROUP BY id, skey, size)
    SELECT q.id AS doc_id, q.size, q.source_size, q.target, CAST(coalesce(tk.taken, 0) AS BIGINT) AS taken
    FROM q LEFT JOIN tk ON q.id IS NOT DISTINCT FROM tk.id AND q.skey = tk.skey AND q.size = tk.size"""


def licenses(threshold: float = 0.8) -> str:
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    rows = ", ".join(f"({k}, {_text(name)}, {len(b := template_bigrams(text))}, {len(template_words(text))}, [{', '.join(map(_text, b))}])"
                     for k, (name, text) in enumerate(TEMPLATES))
    return f"""
    WITH tpl(k, name, n, w, b) AS (VALUES {rows}),
    base AS (SELECT row_number() OVER () AS rid, doc_id, coalesce("text", '') AS t FROM documents),
    units AS (SELECT rid, unnest(ls) AS x, generate_subscripts(ls, 1) - 1 AS pos FROM (SELECT rid, string_split(t, chr(10)) AS ls FROM base)
              UNION ALL SELECT rid, t, -1 FROM base),
    words AS (SELECT rid, pos, regexp_extract_all(translate(x, '{UPPER}', '{LOWER}'), '[a-z0-9]+') AS w FROM units),
    sets AS (SELECT rid, pos, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS own FROM words WHERE len(w) >= 2),
    scored AS (SELECT rid, pos, k, name, 2.0 * len(list_intersect(own, b)) / (len(own) + n) AS dice FROM sets JOIN tpl
               ON len(own) >= n * CAST({low} AS DOUBLE) - 1e-9 AND len(own) <= n * CAST({high} AS DOUBLE) + 1e-9),
    hit AS (SELECT rid, pos, max((CAST(dice AS DOUBLE), -k, -pos)) AS m FROM scored WHERE dice >= {threshold} - 1e-9 GROUP BY rid, pos),
    top AS (SELECT rid, count(*) AS n, max(m) AS m FROM hit GROUP BY rid),
    every AS (SELECT rid, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS bg FROM words WHERE pos = -1 AND len(w) >= 2),
    grams AS (SELECT rid, unnest(bg) AS g, generate_subscripts(bg, 1) AS ix FROM every),
    tg AS (SELECT k, name, n, w, b, unnest(b) AS g FROM tpl),
    starts AS (SELECT rid, ix, k, n, b, list_distinct(bg[ix:ix + w - 2]) AS own FROM grams JOIN tg USING (g) JOIN every USING (rid)),
    inside AS (SELECT rid, k, ix, 2.0 * len(list_intersect(own, b)) / (len(own) + n) AS dice FROM starts),
    win AS (SELECT rid, count(*) AS n, max((CAST(dice AS DOUBLE), -k, 1 - ix)) AS m FROM inside WHERE dice >= {threshold} - 1e-9 GROUP BY rid)
    SELECT doc_id, CAST(len(string_split(t, chr(10))) AS BIGINT) AS n_lines, CAST(coalesce(top.n, 0) AS BIGINT) AS n_matches,
           tpl.name AS license, top.m[1] AS dice, CAST(-top.m[3] AS BIGINT) AS line,
           CAST(coalesce(win.n, 0) AS BIGINT) AS n_windows, tw.name AS window_license, win.m[1] AS window_dice,
           CAST(-win.m[3] AS BIGINT) AS window_word
    FROM base LEFT JOIN top USING (rid) LEFT JOIN tpl ON tpl.k = -top.m[2]
    LEFT JOIN win USING (rid) LEFT JOIN tpl tw ON tw.k = -win.m[2]"""


def near_duplicates(shingle: int = 4, percent: int = 85) -> str:
    k = shingle - 1
    return f"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce("text", ''), '{UPPER}', '{LOWER}'), '{_W}') AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {shingle} THEN [list_aggregate(ws, 'string_agg', ' ')]
            ELSE list_transform(range(1, len(ws) - {k - 1}), lambda i: list_aggregate(ws[i:i + {k}], 'string_agg', ' ')) END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
    l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * o >= {percent} * (nx.c + ny.c - o)),
    r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.x, r.root FROM r JOIN l ON l.y = r.doc_id)
    SELECT d.doc_id, CAST(coalesce(n.c, 0) AS BIGINT) AS n_shingles, m.component_id
    FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)"""


def hard_negatives() -> str:
    return """
    WITH usable AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
                    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS s
              FROM usable a JOIN usable b ON a.id % 100 = 0 AND b.id <> a.id),
    pos AS (SELECT anchor_id, other AS positive_id, s AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, other) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score, s AS negative_score
    FROM pos JOIN pairs USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * s AND 100 * s <= 90 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s DESC, other) QUALIFY row_number() OVER w <= 10"""


def prefix_trie() -> str:
    step = "xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce(list_prepend(xor(crc, b), range(8)), lambda a, z: {step})"
    crc = (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ord(s[i])::BIGINT)), "
           f"lambda crc, b: {byte}), 4294967295::BIGINT)")
    return f"""
    WITH t AS (SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce("text", '') AS txt,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) AS pos
               FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv, conv - conv % 20 AS base, {crc} % 4 AS h FROM (SELECT DISTINCT conv, CAST(conv AS VARCHAR) AS s FROM t)),
    r AS (SELECT c.conv, pos AS d, role, txt FROM c JOIN t ON t.conv = c.base WHERE pos <= h
          UNION ALL SELECT c.conv, pos - h + least(h, (SELECT count(*) FROM t x WHERE x.conv = c.base)) AS d, role, txt
          FROM c JOIN t ON t.conv = c.conv WHERE pos > h),
    p AS (SELECT conv, d, txt, list((d, role, txt)) OVER (PARTITION BY conv ORDER BY d) AS pre FROM r
          UNION ALL SELECT conv, 0, '', [] FROM c),
    len AS (SELECT conv, max(d) AS n FROM p GROUP BY conv),
    on_ AS (SELECT conv, d, txt, min(conv) OVER (PARTITION BY d, pre) AS node FROM p),
    nodes AS (SELECT d, node, count(*) AS n_convs, any_value(len(regexp_extract_all(txt, '{_W}'))) AS words FROM on_ GROUP BY d, node),
    par AS (SELECT n.d, n.node, o.node AS parent FROM nodes n LEFT JOIN on_ o ON o.conv = n.node AND o.d = n.d - 1),
    kids AS (SELECT d - 1 AS d, parent AS node, count(*) AS n FROM par WHERE d > 0 GROUP BY ALL),
    sums AS (SELECT o.d, o.node, count(*) FILTER (k.n IS NULL) AS n_leaves, sum((u.n_convs - 1) * u.words) AS saved
             FROM nodes u LEFT JOIN kids k ON k.d = u.d AND k.node = u.node JOIN on_ o ON o.conv = u.node AND o.d <= u.d GROUP BY o.d, o.node),
    ends AS (SELECT o.d, o.node, string_agg(CAST(o.conv AS VARCHAR), ',' ORDER BY o.conv) AS ids
             FROM on_ o JOIN len ON len.conv = o.conv AND len.n = o.d GROUP BY o.d, o.node)
    SELECT n.node AS conv_id, n.d AS depth, par.parent AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children, n_leaves,
           CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM nodes n JOIN par USING (d, node) JOIN sums USING (d, node) LEFT JOIN kids USING (d, node) LEFT JOIN ends USING (d, node)"""
