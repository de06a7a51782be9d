"""Queries and SQL of the operators for training data, by name."""

from __future__ import annotations

from undertone.llm import language, leakage, lookalike, mixing, overlap, personal, splitting, tokenise, transcripts


def queries() -> dict:
    return {
        "p1_found": mixing.p1_found,
        "p1_shares": mixing.p1_shares,
        "p1_draw": mixing.p1_draw,
        "p3_found": language.p3_found,
        "p3_passages": language.p3_passages,
        "p4_found": overlap.p4_found,
        "p4_links": overlap.p4_links,
        "p4_report": overlap.p4_report,
        "p5_found": splitting.p5_found,
        "p5_pieces": splitting.p5_pieces,
        "p5_text_pieces": splitting.p5_text_pieces,
        "p6_found": transcripts.p6_found,
        "p6_turns": transcripts.p6_turns,
        "p7_found": lookalike.p7_found,
        "p7_classes": lookalike.p7_classes,
        "p7_canonical": lookalike.p7_canonical,
        "p8_ids": tokenise.p8_ids,
        "p8_token_counts": tokenise.p8_token_counts,
        "p9_found": leakage.p9_found,
        "p9_removed": leakage.p9_removed,
        "p9_coverage": leakage.p9_coverage,
        "p9_by_set": leakage.p9_by_set,
        "p10_found": personal.p10_found,
        "p10_redacted": personal.p10_redacted,
        "p10_surrogates": personal.p10_surrogates,
    }


def oracle_sql() -> dict[str, str]:
    """SQL of the problems that SQL can state plainly; the others are tested
    against brute force, round trips or held-out accuracy."""
    return {"p1_found": P1, "p5_found": P5, "p7_found": P7, "p9_found": P9, "p9_coverage": P9_COVERAGE, "p9_by_set": P9_BY_SET}


P1 = """WITH e AS (SELECT * FROM (SELECT *, trim(name) AS nm, row_number() OVER (PARTITION BY trim(name) ORDER BY spec_id) AS rn FROM dataset_specs WHERE split = 'train') WHERE rn = 1),
c AS (SELECT trim(dataset) AS nm, count(DISTINCT sample_id) AS n FROM mds_samples GROUP BY 1),
v AS (SELECT nm, weight, CASE WHEN choose IS NULL THEN coalesce(n, 0) ELSE least(coalesce(n, 0), choose) END AS available, coalesce("repeat", 4) AS r FROM e LEFT JOIN c USING (nm) WHERE weight > 0 AND NOT (choose IS NOT NULL AND "repeat" IS NOT NULL))
SELECT nm AS name FROM v WHERE weight / (SELECT sum(weight) FROM v) * (SELECT sum(available) FROM v) > available * r"""

P5 = """WITH RECURSIVE i AS (SELECT item_id, any_value(trim(set_name)) AS set_name, any_value(CASE WHEN duration > 0 THEN duration ELSE n_bytes / 32000.0 END) AS d FROM eval_items GROUP BY item_id),
o AS (SELECT item_id, d, chunk_s AS ch, coalesce(overlap_s, 0) AS ov FROM i JOIN eval_sets s ON s.name = i.set_name WHERE (max_audio_s IS NULL OR d <= max_audio_s) AND d > chunk_s),
m AS (SELECT DISTINCT o.item_id, (start_ms + end_ms) / 2000.0  AS mid FROM o JOIN item_pauses p USING (item_id) WHERE start_ms > 0 AND end_ms < d * 1000 AND end_ms - start_ms >= 200),
w AS (SELECT item_id, 0.0::double AS start, 0.0::double AS last FROM o UNION ALL
 SELECT w.item_id, (SELECT max(mid) FROM m WHERE m.item_id = w.item_id AND mid > w.last AND mid <= w.start + o.ch + 1e-9) - o.ov, (SELECT max(mid) FROM m WHERE m.item_id = w.item_id AND mid > w.last AND mid <= w.start + o.ch + 1e-9)
 FROM w JOIN o USING (item_id) WHERE o.d - w.start > o.ch + 1e-9 AND (SELECT max(mid) FROM m WHERE m.item_id = w.item_id AND mid > w.last AND mid <= w.start + o.ch + 1e-9) - o.ov > w.start)
SELECT o.item_id, CASE WHEN max(o.d - w.start - o.ch) FILTER (WHERE w.start = s.top) <= 1e-9 THEN 'natural' ELSE 'forced' END AS cut_kind FROM o JOIN w USING (item_id) JOIN (SELECT item_id, max(start) AS top FROM w GROUP BY item_id) s USING (item_id) GROUP BY o.item_id"""

_ALL = lookalike.known_characters()
P7 = f"""WITH r AS (SELECT DISTINCT k, t, {lookalike.canonical_sql('t', _ALL)} AS c FROM (SELECT sample_id AS k, response_text AS t FROM mds_samples UNION ALL SELECT item_id, answer FROM eval_items) WHERE t IS NOT NULL)
SELECT DISTINCT a.k AS key_a, b.k AS key_b FROM r a JOIN r b ON a.c = b.c AND a.k < b.k AND a.t <> b.t WHERE a.c <> ''"""

_WORDS = leakage.words_sql("text", _ALL)
P9 = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL), p AS (SELECT passage_id, lang, {_WORDS} AS w FROM heldout_passages),
dw AS (SELECT doc_id, string_split(w, ' ') AS ws FROM d), pw AS (SELECT passage_id, string_split(w, ' ') AS ws FROM p WHERE lang <> 'zh'),
dr AS (SELECT DISTINCT doc_id, array_to_string(ws[k:k + 9], ' ') AS run FROM (SELECT *, unnest(range(1, len(ws) - 8)) AS k FROM dw WHERE len(ws) >= 10)),
pr AS (SELECT DISTINCT passage_id, array_to_string(ws[k:k + 9], ' ') AS run FROM (SELECT *, unnest(range(1, len(ws) - 8)) AS k FROM pw WHERE len(ws) >= 10)),
dc AS (SELECT DISTINCT doc_id, substr(c, k, 20) AS run FROM (SELECT doc_id, c, unnest(range(1, length(c) - 18)) AS k FROM (SELECT doc_id, replace(w, ' ', '') AS c FROM d WHERE regexp_matches(w, '[\\x{{4e00}}-\\x{{9fff}}]')) WHERE length(c) >= 20)),
pc AS (SELECT DISTINCT passage_id, substr(c, k, 20) AS run FROM (SELECT passage_id, c, unnest(range(1, length(c) - 18)) AS k FROM (SELECT passage_id, replace(w, ' ', '') AS c FROM p WHERE lang = 'zh') WHERE length(c) >= 20))
SELECT DISTINCT doc_id, passage_id FROM dr JOIN pr USING (run) UNION SELECT DISTINCT doc_id, passage_id FROM dc JOIN pc USING (run)"""

P9_COVERAGE = f"""WITH d AS (SELECT DISTINCT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL), p AS (SELECT passage_id, {_WORDS} AS w FROM heldout_passages WHERE lower(trim(coalesce(lang, ''))) NOT LIKE 'zh%'),
dw AS (SELECT doc_id, string_split(w, ' ') AS ws FROM d), pw AS (SELECT string_split(w, ' ') AS ws FROM p),
dr AS (SELECT doc_id, k, len(ws) AS n, array_to_string(ws[k:k + 9], ' ') AS run FROM (SELECT *, unnest(range(1, len(ws) - 8)) AS k FROM dw WHERE len(ws) >= 10)),
pr AS (SELECT DISTINCT array_to_string(ws[k:k + 9], ' ') AS run FROM (SELECT *, unnest(range(1, len(ws) - 8)) AS k FROM pw WHERE len(ws) >= 10))
SELECT doc_id, max(n)::int AS n_tokens, count(DISTINCT i)::int AS n_leaked FROM (SELECT doc_id, n, unnest(range(k, k + 10)) AS i FROM dr JOIN pr USING (run)) GROUP BY doc_id"""

P9_BY_SET = f"SELECT set_name, count(DISTINCT passage_id) AS n_items, count(DISTINCT doc_id) AS n_docs FROM ({P9}) AS h JOIN heldout_passages USING (passage_id) GROUP BY set_name"
