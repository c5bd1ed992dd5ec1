"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from . import chat, licences, manifest, negatives


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(line: str) -> str:
    words = f"regexp_replace(lower({line}), {_text(licences.NOT_WORD)}, ' ', 'g')"
    for old, new in licences.SPELLINGS:
        words = f"replace({words}, {_text(old)}, {_text(new)})"
    return (
        f"CASE WHEN regexp_matches(lower({line}), {_text(licences.COPYRIGHT_LINE)}) THEN '' "
        f"ELSE trim({words}) END"
    )


def _lines(text: str) -> str:
    lines = f"list_transform(string_split({text}, chr(10)), lambda line: {_canonical('line')})"
    return f"list_filter({lines}, lambda x: x <> '')"


def _core(lines: str) -> str:
    text = f"array_to_string({lines}, ' ')"
    return f"regexp_replace({text}, {_text(licences.LEADING_TITLES)}, '')"


def license_scan() -> str:
    known = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in licences.KNOWN)
    ready = ", ".join(f"({_text(name)}, {_text(digest)})" for name, digest in licences.WHOLE)
    number = r"(?m)^\s*\d+[.)]\s"
    return f"""
WITH known_texts(license_id, text) AS (VALUES {known}),
forms AS (
    SELECT license_id, text FROM known_texts
    UNION ALL SELECT license_id, regexp_replace(text, '{number}', '', 'g') FROM known_texts),
known AS (
    SELECT digest, min(license_id) AS license_id FROM (
        SELECT license_id, sha256({_core("lines")}) AS digest
        FROM (SELECT license_id, {_lines("text")} AS lines FROM forms)
        UNION ALL SELECT * FROM (VALUES {ready}) v(license_id, digest))
    GROUP BY digest),
numbered AS (
    SELECT row_number() OVER () AS n, doc_id, {_lines("coalesce(text, '')")} AS lines FROM documents),
digests AS (SELECT n, doc_id, lines, sha256({_core("lines")}) AS digest FROM numbered),
units AS (SELECT n, unnest(list_transform(lines, lambda x: sha256(x))) AS line_digest FROM digests)
SELECT d.doc_id, d.digest, max(k.license_id) AS license_id,
       string_agg(DISTINCT o.license_id, ',' ORDER BY o.license_id) AS notices,
       count(u.line_digest) AS n_lines
FROM digests d
LEFT JOIN known k ON k.digest = d.digest
LEFT JOIN units u ON u.n = d.n
LEFT JOIN known o ON o.digest = u.line_digest
GROUP BY d.doc_id, d.digest"""


def warc_records() -> str:
    return """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id
                 AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END
           AS refers_to
FROM firsts"""


def chat_digests() -> str:
    span = (chat.BUDGET - chat.HISTORY) // 2
    return rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL
    SELECT -1, n, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)),
sized AS (
    SELECT *, greatest(1, len(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s]')))
                  AS tokens,
           length('<s>[INST][/INST]</s>') + length(role) + length(text)
               + len(regexp_extract_all(role || text, '\\'))
               + 2 * (len(regexp_extract_all(role, '</?s>|\[/?INST\]'))
                      + len(regexp_extract_all(text, '</?s>|\[/?INST\]'))) AS chars
    FROM turns),
placed AS (
    SELECT *, row_number() OVER w - 1 AS pos, coalesce(sum(tokens) OVER w - tokens, 0) AS before
    FROM sized
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cut AS (SELECT *, before // {span} AS part FROM placed),
parts AS (
    SELECT conv_id, part, max(before + tokens) AS part_end,
           row_number() OVER (PARTITION BY conv_id ORDER BY part) AS number,
           count(*) OVER (PARTITION BY conv_id) AS number_of
    FROM cut GROUP BY conv_id, part),
lengths AS (
    SELECT c.conv_id,
           sum(c.chars * CASE
               WHEN c.pos = 0 AND c.role = 'system' THEN p.number_of
               WHEN p.number < p.number_of AND p.part_end - c.before <= {chat.HISTORY} THEN 2
               ELSE 1 END)::BIGINT AS formatted_chars
    FROM cut c
    JOIN parts p ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.part = p.part
    GROUP BY c.conv_id),
digests AS (
    SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), ''))
           AS loss_sha256
    FROM placed GROUP BY conv_id)
SELECT d.*, l.formatted_chars
FROM digests d JOIN lengths l ON d.conv_id IS NOT DISTINCT FROM l.conv_id"""


def hard_negatives() -> str:
    s = negatives.Settings()
    return f"""
WITH valid AS (
    SELECT vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor({s.scale} * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id,
           list_inner_product(a.q, r.q)::BIGINT AS score
    FROM valid a JOIN valid r ON a.vec_id <> r.vec_id
    WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id)
            <= {s.positives})
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                          ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 100 * n.score BETWEEN {s.low} * p.positive_score AND {s.high} * p.positive_score
QUALIFY rank <= {s.negatives}"""


def _levels(name: str, leaves: str, n: int) -> str:
    """Nodes and steps of n levels: (tree, size, pos, hash), and digests before and after."""
    fanout = manifest.FANOUT
    parts = [f"{name}0 AS ({leaves})"]
    for i in range(n):
        parts.append(f"""
{name}{i + 1} AS (
    SELECT tree, (size + {fanout - 1}) // {fanout} AS size, pos // {fanout} AS pos,
           sha256(string_agg(hash, '' ORDER BY pos)) AS hash
    FROM {name}{i} WHERE size > 1 GROUP BY tree, size, pos // {fanout}),
{name}_step{i} AS (
    SELECT tree, pos, coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
                                                            AND 1 PRECEDING), '') AS before,
           coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING
                                                 AND UNBOUNDED FOLLOWING), '') AS after
    FROM {name}{i} WHERE size > 1
    WINDOW w AS (PARTITION BY tree, pos // {fanout} ORDER BY pos))""")
    roots = " UNION ALL ".join(f"SELECT tree, hash FROM {name}{i} WHERE size = 1" for i in range(n + 1))
    return ", ".join([*parts, f"{name}_root AS ({roots})"])


def _climb(start: str, name: str, tree: str, pos: str, n: int) -> str:
    """A fold of ``up`` and ``proof`` through n levels, as nested selects."""
    query = start
    for i in range(n):
        query = f"""
SELECT t.* REPLACE (CASE WHEN s.before IS NULL THEN t.up ELSE sha256(s.before || t.up || s.after) END
                        AS up,
                    t.proof || coalesce(s.before || s.after, '') AS proof)
FROM ({query}) t LEFT JOIN {name}_step{i} s
  ON s.tree = t.{tree} AND s.pos = t.{pos} // {manifest.FANOUT ** i}"""
    return query


def merkle_manifest(levels: int = 14, top_levels: int = 8) -> str:
    """Trees of up to 3^14 rows under up to 3^8 sources."""
    fields = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in manifest.FIELDS]
    leaf = f"sha256({' || '.join(fields)})"
    changed = leaf.replace("text::VARCHAR", "replace(text, chr(10), '')")
    digits = (
        "list_concat([4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
        "lambda d: [unicode(d)::BIGINT, 256, 256, 256, 256, 256, 256, 256, 256])))"
    )
    crc = (
        f"xor(list_reduce({digits}, lambda a, e: CASE WHEN e < 256 THEN xor(a, e) "
        "ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"
    )
    own = _levels(
        "n", "SELECT tree, size, pos, leaf AS hash FROM placed", levels
    )
    top = _levels(
        "t",
        "SELECT 0 AS tree, count(*) OVER () AS size, tree AS pos, hash FROM n_root",
        top_levels,
    )
    start = "SELECT *, 0 AS zero, claim AS up, '' AS proof FROM placed"
    climbed = _climb(_climb(start, "n", "tree", "pos", levels), "t", "zero", "tree", top_levels)
    return f"""
WITH hashed AS (
    SELECT doc_id, source, {leaf} AS leaf,
           CASE WHEN {crc} % 2 = 0 THEN {changed} ELSE {leaf} END AS claim
    FROM documents),
placed AS (
    SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
           count(*) OVER (PARTITION BY source) AS size,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS pos
    FROM hashed),
{own},
{top},
climbed AS ({climbed})
SELECT c.doc_id, c.leaf, s.hash AS subroot, r.hash AS root, sha256(c.proof) AS proof_sha256,
       c.up AS folded_root, c.up = r.hash AS verified
FROM climbed c JOIN n_root s ON s.tree = c.tree CROSS JOIN t_root r"""


#: Character references that the pages of the given tables hold, some cut before the
#: semicolon, which these may lack; & comes last.
REFERENCES = (("copy", "©"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&"))


def article_texts() -> str:
    """For pages that mark their article with its tag and hold only plain paragraphs in it."""
    article = "coalesce(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '')"
    text = "regexp_replace(b, '<br>', ' ', 'g')"
    text = f"regexp_replace({text}, '<[^>]*>', '', 'g')"
    for name, character in REFERENCES:
        text = f"regexp_replace({text}, '&{name};?', {_text(character)}, 'g')"
    text = rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"
    return f"""
WITH blocks AS (
    SELECT page_id, url, list_filter(list_transform(
        regexp_split_to_array({article}, '</?(p|h1)>'), lambda b: {text}), lambda b: b <> '') AS found
    FROM pages)
SELECT page_id, url, array_to_string(found, chr(10) || chr(10)) AS text,
       length(array_to_string(found, chr(10) || chr(10))) AS n_chars
FROM blocks"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": license_scan(),
        "op6_warc": warc_records(),
        "op9_chat_format": chat_digests(),
        "op11_hard_negatives": hard_negatives(),
        "op12_merkle_manifest": merkle_manifest(),
        "op13_html_extraction": article_texts(),
    }
