"""SQL that gives the rows of a query by a plainer way, for DuckDB."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Every document's smallest id along links; links hold both directions.
COMPONENTS = """
    reach AS (SELECT {id} AS id, {id} AS to_id FROM {nodes}
              UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.to_id),
    least AS (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id)
"""

MINHASH = rf"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS words FROM documents),
    s AS (SELECT DISTINCT doc_id, words[i:i + 4] AS shingle FROM (SELECT *, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w)
          WHERE len(words) > 0),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
              JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id GROUP BY x.doc_id, y.doc_id
              HAVING 100 * count(*) >= 85 * (any_value(nx.n) + any_value(ny.n) - count(*))),
    {COMPONENTS.format(id="doc_id", nodes="documents")}
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept
    FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN least ON id = d.doc_id
"""

EMBEDDINGS = f"""
    WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
          WHERE label IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
            AND len([x for x in embedding if x <> 0]) > 0),
    links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
              AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
    {COMPONENTS.format(id="vec_id", nodes="embeddings")}
    SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, component_id = vec_id AS kept
    FROM embeddings JOIN least ON id = vec_id
"""

LINES = r"""
    WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
    x AS (SELECT doc_id, pos, lines[pos] AS line FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS pos FROM l)),
    q AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq,
                 CASE WHEN regexp_matches(line, '\p{L}') THEN len(regexp_split_to_array(trim(line), '\s+')) ELSE 0 END AS words
          FROM x WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    pairs AS (SELECT a.doc_id, a.seq, b.doc_id AS other, a.seq - b.seq AS shift FROM q a JOIN q b ON a.line = b.line AND (b.doc_id, b.seq) < (a.doc_id, a.seq)),
    islands AS (SELECT *, seq - row_number() OVER (PARTITION BY doc_id, other, shift ORDER BY seq) AS island FROM pairs),
    runs AS (SELECT doc_id, seq, max(last - seq + 1) AS n
             FROM (SELECT *, max(seq) OVER (PARTITION BY doc_id, other, shift, island) AS last FROM islands) GROUP BY doc_id, seq),
    counted AS (SELECT r.doc_id, r.seq, any_value(n) AS n, sum(words) AS words FROM runs r JOIN q ON q.doc_id = r.doc_id AND q.seq BETWEEN r.seq AND r.seq + n - 1
                GROUP BY r.doc_id, r.seq),
    gone AS (SELECT doc_id, unnest(range(seq, seq + n)) AS seq, n FROM counted WHERE words >= 5),
    left_ AS (SELECT x.doc_id, string_agg(x.line, chr(10) ORDER BY x.pos) AS text, count(*) AS n FROM x LEFT JOIN q USING (doc_id, pos)
              WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = x.doc_id AND g.seq = q.seq) GROUP BY x.doc_id)
    SELECT l.doc_id, CASE WHEN l.text IS NOT NULL THEN coalesce(left_.text, '') END AS text, coalesce(len(lines), 0) AS n_lines,
           coalesce(len(lines), 0) - coalesce(left_.n, 0) AS n_removed,
           coalesce((SELECT max(n) FROM gone WHERE gone.doc_id = l.doc_id), 0) AS run_lines
    FROM l LEFT JOIN left_ ON left_.doc_id = l.doc_id
"""

RULES = rf"""
    WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
    x AS (SELECT doc_id, i, words[i:i + 4] AS five FROM (SELECT *, unnest(range(1, len(words) - 3)) AS i FROM w)),
    r AS (SELECT doc_id, unnest(range(i, i + 5)) AS place FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, five) AS n FROM x) WHERE n > 1),
    c AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM r GROUP BY doc_id),
    m AS (SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
                 len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
                 [y for y in string_split(text, chr(10)) if regexp_matches(y, '[^\x20\x09-\x0D]')] AS lines,
                 coalesce(n_repeat_words, 0) AS n_repeat_words,
                 len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '[A-Za-z]')) AS n_letters
          FROM w LEFT JOIN c ON c.doc_id = w.doc_id),
    k AS (SELECT * EXCLUDE (lines), len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines FROM m),
    f AS (SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT + 4 * (100 * n_symbols > 10 * n_words)::BIGINT
                 + 8 * (100 * n_dup_lines > 30 * n_lines)::BIGINT + 16 * (100 * n_upper > 40 * n_letters)::BIGINT
                 + 32 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::BIGINT AS failed FROM k)
    SELECT *, failed & 3 <> 0 AS base_failed, failed & 31 = 0 AS kept FROM f
"""

FILL_MIDDLE = r"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                      sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    k AS (SELECT *, len(units) AS n, [('0x' || h[8 * i + 1:8 * i + 8])::BIGINT for i in range(4)] AS x FROM t),
    c AS (SELECT *, least(x[1] % (n + 1), x[2] % (n + 1)) AS a, greatest(x[1] % (n + 1), x[2] % (n + 1)) AS b,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR x[3] % 100 >= 90 THEN 'plain'
                      WHEN x[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k),
    p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
                 array_to_string(units[b + 1:], '') AS suffix FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM p
"""

# The remainder of a division by 3 of the CRC-32 of a number's digits.
_CRC_STEP = "list_reduce([{x}, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
_CRC = f"xor(list_reduce([4294967295::UBIGINT] || [ord(d)::UBIGINT for d in string_split(doc_id::VARCHAR, '')], lambda s, d: {_CRC_STEP.format(x='xor(s, d)')}), 4294967295)"


def _told(value: str) -> str:
    return f"coalesce(octet_length(encode(({value})::VARCHAR)) || ':' || ({value})::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_told, ['doc_id', 'source', 'lang', 'n_chars', text]))})"


# Nodes of every level; a tree ends with the level that has one.
_TREE = """
    {name} AS (SELECT tree, 0 AS level, pos, node, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
          UNION ALL SELECT tree, level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 7) // 8 FROM {name}
                    WHERE n > 1 GROUP BY tree, level, pos // 8)
"""

# A step up: the siblings of a node stand before and after it in its run of eight.
_BEFORE, _AFTER = "substr(nodes, 1, (pos % 8 * 64)::BIGINT)", "substr(nodes, (pos % 8 * 64 + 65)::BIGINT)"
_CLIMB = f"up.level + 1, pos // 8, sha256({_BEFORE} || folded || {_AFTER}), proof || {_BEFORE} || {_AFTER}"

MERKLE = f"""
    WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf("text")} AS node, doc_id IS NOT NULL AND {_CRC} % 3 = 0 AS hit,
              {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS other FROM documents),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS pos FROM d),
    {_TREE.format(name="g", leaves="leaves")},
    tops AS (SELECT '' AS tree, tree AS name, node, row_number() OVER (ORDER BY tree) - 1 AS pos FROM g WHERE n = 1),
    {_TREE.format(name="a", leaves="tops")},
    gr AS (SELECT tree, level, pos // 8 AS run, string_agg(node, '' ORDER BY pos) AS nodes FROM g WHERE n > 1 GROUP BY tree, level, pos // 8),
    ar AS (SELECT tree, level, pos // 8 AS run, string_agg(node, '' ORDER BY pos) AS nodes FROM a WHERE n > 1 GROUP BY tree, level, pos // 8),
    up AS (SELECT tree AS own, pos AS spot, 0 AS level, pos, CASE WHEN hit THEN other ELSE node END AS folded, '' AS proof FROM leaves
           UNION ALL SELECT own, spot, {_CLIMB} FROM up JOIN gr ON gr.tree = own AND gr.level = up.level AND run = pos // 8),
    half AS (SELECT own, spot, folded, proof FROM up JOIN (SELECT tree, level FROM g WHERE n = 1) e ON e.tree = own AND e.level = up.level),
    more AS (SELECT own, spot, 0 AS level, tops.pos, folded, proof FROM half JOIN tops ON name = own
             UNION ALL SELECT own, spot, {_CLIMB.replace("up.", "more.").replace("gr.", "ar.")} FROM more JOIN ar ON ar.level = more.level AND run = pos // 8),
    whole AS (SELECT own, spot, folded, proof FROM more JOIN (SELECT level FROM a WHERE n = 1) e ON e.level = more.level)
    SELECT doc_id, leaves.node AS leaf, tops.node AS subroot, a.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = a.node AS verified
    FROM whole JOIN leaves ON leaves.tree = own AND leaves.pos = spot JOIN tops ON name = own JOIN a ON a.n = 1
"""
