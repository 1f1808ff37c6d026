"""SQL checks of the operators that SQL can express."""

from __future__ import annotations

from rapport.llm.licenses import RULES, SENTENCES

_IDENTIFIER = " ".join(f"WHEN regexp_matches(plain, '{pattern}') THEN '{name}'" for name, pattern in SENTENCES)


def _used_up() -> str:
    """One nested select per rule: what the rule leaves of the identifiers, and whether it was found."""
    text = "SELECT *, '|' || array_to_string(sentence_ids, '||') || '|' AS rest, [''] AS found FROM lists"
    for name, run in RULES:
        part = "|" + "||".join(run) + "|"
        text = (
            f"SELECT * REPLACE (replace(rest, '{part}', '#') AS rest, "
            f"if(contains(rest, '{part}'), list_append(found, '{name}'), found) AS found) FROM ({text})"
        )
    return text


OP1 = rf"""WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, text FROM documents),
cut AS (SELECT row_no, generate_subscripts(parts, 1) AS place, unnest(parts) AS sentence FROM (
  SELECT row_no, string_split_regex(regexp_replace(text, '([.!?]+)([^A-Za-z0-9]|$)', '\1' || chr(1) || '\2', 'g'),
    '[.!?]+' || chr(1) || '|;|\n[ \t]*\n') AS parts FROM docs)),
known AS (SELECT row_no, place, sentence, CASE {_IDENTIFIER} END AS id FROM (
  SELECT *, trim(regexp_replace(regexp_replace(lower(sentence), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), '\blicence', 'license', 'g'))
    AS plain FROM cut)),
lists AS (SELECT doc_id, coalesce(k.ids, []) AS sentence_ids, coalesce(k.sentences, []) AS sentences
  FROM docs LEFT JOIN (SELECT row_no, list(id ORDER BY place) AS ids, list(trim(sentence) ORDER BY place) AS sentences
    FROM known WHERE id IS NOT NULL GROUP BY row_no) k USING (row_no))
SELECT doc_id, array_to_string([found[i] for i in range(2, len(found) + 1) if list_position(found, found[i]) = i], ', ')
  AS licenses, array_to_string(sentence_ids, ', ') AS sentence_ids, cast(len(sentence_ids) AS bigint) AS n_sentences,
  array_to_string(sentences, chr(10)) AS sentences FROM ({_used_up()})"""

OP9 = """WITH RECURSIVE good AS (SELECT row_number() OVER () AS row_no, vec_id, label, embedding::double[] AS e FROM embeddings),
fine AS (SELECT * FROM good WHERE vec_id IS NOT NULL AND label IS NOT NULL
  AND len([x for x in e if x IS NOT NULL AND isfinite(x)]) = len(e) AND len([x for x in e if x <> 0]) > 0),
links AS (SELECT a.row_no, a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b
  ON a.label = b.label AND a.row_no <> b.row_no AND len(a.e) = len(b.e)
  AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.98 END),
reach(vec_id, other) AS (SELECT a, b FROM links UNION SELECT vec_id, b FROM reach JOIN links ON other = a)
SELECT vec_id, n_links, component_id, coalesce(vec_id = component_id, false) AS kept FROM (
  SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, low) AS component_id FROM good
    LEFT JOIN (SELECT row_no, count(*) AS n FROM links GROUP BY row_no) USING (row_no)
    LEFT JOIN (SELECT vec_id, min(other) AS low FROM reach GROUP BY vec_id) USING (vec_id))"""

ORACLES = {"op1_licenses": OP1, "op9_embeddings": OP9}
