"""Schema drift of shards (problem 2) with SQL that compares the lists directly."""

from __future__ import annotations

from undertone.operators import schema_drift as sd
from undertone.plans.base import query

SHARDS = """s AS (SELECT shard_id, trim(any_value(dataset)) AS dataset, any_value(subdir) AS subdir, any_value(shard_no) AS shard_no, any_value(written_at) AS written_at,
 list_transform(any_value(column_names), lambda x: lower(trim(x))) AS names, any_value(column_encodings) AS types FROM shard_index GROUP BY shard_id),
p AS (SELECT *, lag(names) OVER w AS old, lag(types) OVER w AS old_types FROM s WINDOW w AS (PARTITION BY dataset, subdir ORDER BY written_at, shard_no, shard_id)),
q AS (SELECT * FROM p WHERE old IS NOT NULL),
o AS (SELECT shard_id, unnest(old) AS name, unnest(old_types) AS type, generate_subscripts(old, 1) AS pos, names, types, old FROM q),
n AS (SELECT shard_id, unnest(names) AS name, unnest(types) AS type, generate_subscripts(names, 1) AS pos, old, old_types, names FROM q),
ren AS (SELECT o.shard_id, o.name, n.name AS new_name FROM o JOIN n ON n.shard_id = o.shard_id AND n.pos = o.pos AND n.type = o.type WHERE len(o.old) = len(o.names) AND o.name <> n.name AND NOT list_contains(o.names, o.name) AND NOT list_contains(n.old, n.name))"""


@query(
    "p2_found",
    f"""WITH {SHARDS} SELECT shard_id, name AS column_name, 'renamed' AS change_kind FROM ren
UNION SELECT shard_id, name, 'removed' FROM o WHERE NOT list_contains(names, name) AND NOT EXISTS (SELECT 1 FROM ren WHERE ren.shard_id = o.shard_id AND ren.name = o.name)
UNION SELECT shard_id, name, 'added' FROM n WHERE NOT list_contains(old, name) AND NOT EXISTS (SELECT 1 FROM ren WHERE ren.shard_id = n.shard_id AND ren.new_name = n.name)
UNION SELECT n.shard_id, n.name, 'retyped' FROM n JOIN o ON o.shard_id = n.shard_id AND o.name = n.name AND o.type <> n.type""",
)
def p2_found(spark, d):
    return sd.p2_found(spark, d)


LISTS = """s AS (SELECT shard_id, trim(any_value(dataset)) AS dataset, any_value(subdir) AS subdir, any_value(shard_no) AS shard_no, any_value(written_at) AS written_at,
 list_transform(any_value(column_names), lambda x: lower(trim(x))) AS names, any_value(column_encodings) AS types FROM shard_index GROUP BY shard_id),
p AS (SELECT *, row_number() OVER (PARTITION BY dataset, subdir ORDER BY written_at, shard_no, shard_id) AS seq FROM s),
f AS (SELECT DISTINCT dataset, subdir, seq, name, type FROM (SELECT dataset, subdir, seq, unnest(names) AS name, unnest(types) AS type FROM p))"""
_ALIAS = ", ".join(f"('{n}', '{f}', '{t}')" for f, t, names in sd.ALIASES for n in names)

query(
    "p2_lifespans",
    f"""WITH {LISTS}, i AS (SELECT *, seq - row_number() OVER (PARTITION BY dataset, subdir, name, type ORDER BY seq) AS g FROM f),
l AS (SELECT dataset, subdir, name, type, min(seq) AS first_seq, max(seq) AS last_seq FROM i GROUP BY dataset, subdir, name, type, g)
SELECT *, row_number() OVER (PARTITION BY dataset, subdir, name, type ORDER BY first_seq) AS lifespan_no FROM l""",
)(sd.p2_lifespans)
query(
    "p2_casts",
    f"""WITH {LISTS}, a AS (SELECT * FROM (VALUES {_ALIAS}) AS v(name, field, cast_to)), n AS (SELECT name, type, count(DISTINCT (dataset, subdir)) AS n_producers FROM f GROUP BY name, type)
SELECT coalesce(a.field, n.name) AS field, n.name, n.type, coalesce(a.cast_to, 'string') AS cast_to, n.n_producers FROM n LEFT JOIN a ON a.name = n.name""",
)(sd.p2_casts)
query("p2_table")(sd.p2_table)
