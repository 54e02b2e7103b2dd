"""DuckDB SQL for the operators that SQL can express, written from their definitions.

op4, op6 and op12 in full.  The others hold hashes, models, graphs, token
ranks or dynamic programs that SQL lacks; they are compared with brute force
in the tests.
"""

from __future__ import annotations

from .chat_format import INSTRUCT, START, Template

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def quoted(text: str) -> str:
    """An SQL string; line breaks as chr(10)."""
    return " || chr(10) || ".join("'" + x.replace("'", "''") + "'" for x in text.split("\n"))


def line_dedup_sql(min_chars: int = 10) -> str:
    """Lines as rows; a key's owner is its smallest document."""
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT r, doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS i FROM docs),
keyed AS (SELECT *, translate(trim(line, {white}), '{UPPER}', '{LOWER}') AS k FROM lines),
shared AS (
  SELECT k, min(doc_id) AS owner FROM keyed
  WHERE length(k) >= {min_chars} GROUP BY k HAVING count(DISTINCT doc_id) >= 2
),
told AS (SELECT a.r, a.doc_id, a.i, a.line, coalesce(s.owner <> a.doc_id, FALSE) AS goes FROM keyed a LEFT JOIN shared s ON s.k = a.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count_if(goes) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT goes), '')) AS kept_sha256
FROM told GROUP BY r
"""


def containment_sql(threshold: float = 0.8, width: int = 5) -> str:
    """Distinct shingles of items and documents as rows, joined and counted."""

    def words(table: str, columns: str) -> str:
        return f"SELECT {columns}, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM {table}"

    shingles = "list_distinct([array_to_string(w[i:i + n - 1], ' ') for i in range(1, len(w) - n + 2)])"
    return f"""
WITH items AS (SELECT DISTINCT * FROM ({words("benchmark", "item_id")}) WHERE item_id IS NOT NULL AND len(w) > 0),
sized AS (SELECT *, least(len(w), {width}) AS n FROM items),
item_parts AS (SELECT item_id, n, unnest({shingles}) AS s FROM sized),
wanted AS (SELECT item_id, count(*) AS n_shingles FROM item_parts GROUP BY item_id),
docs AS ({words("documents", "row_number() OVER () AS r, doc_id")}),
lengths AS (SELECT DISTINCT n FROM sized),
doc_parts AS (SELECT r, doc_id, n, unnest({shingles}) AS s FROM docs, lengths WHERE len(w) >= n),
met AS (SELECT d.r, d.doc_id, p.item_id, count(*) AS n_shared FROM doc_parts d JOIN item_parts p ON p.s = d.s AND p.n = d.n GROUP BY ALL)
SELECT m.doc_id, m.item_id, CAST(t.n_shingles AS INTEGER) AS n_shingles, CAST(m.n_shared AS INTEGER) AS n_shared,
  CAST(m.n_shared AS DOUBLE) / t.n_shingles AS containment
FROM met m JOIN wanted t USING (item_id)
WHERE m.n_shared >= ceil(t.n_shingles * {threshold} - 1e-9)
"""


def chat_format_sql(template: Template = INSTRUCT) -> str:
    """The template as a CASE over roles, the machine as pairs of neighbours."""

    def escaped(x: str) -> str:
        out = f"replace({x}, '\\', '\\\\')"
        for c in template.controls:
            out = f"replace({out}, {quoted(c)}, {quoted(c[0] + chr(92) + c[1:])})"
        return out

    def roles(names) -> str:
        return "(" + ", ".join(quoted(r) for r in names) + ")"

    body = escaped("text")
    cases = " ".join(f"WHEN {quoted(r)} THEN {quoted(a)} || {body} || {quoted(z)}" for r, (a, z) in template.turns.items())
    a, b = template.other[0].split("{role}")
    other = f"{quoted(a)} || {escaped('role')} || {quoted(b)} || {body} || {quoted(template.other[1])}"
    moves = " OR ".join(
        f"({'place = 0' if r == START else f'place > 0 AND before = {quoted(r)}'} AND role IN {roles(n)})" for r, n in template.moves.items())
    probe = "'</s>[INST] ok [/INST]'"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {probe} UNION ALL SELECT -7, 1, 'assistant', {probe}
),
placed AS (
  SELECT *, row_number() OVER w - 1 AS place, lag(role) OVER w AS before, lead(role) OVER w IS NULL AS ends
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
made AS (SELECT *, CASE role {cases} ELSE {other} END AS f, coalesce({moves}, FALSE) AS allowed FROM placed)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role IN {roles(sorted(template.loss))}), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role IN {roles(sorted(template.loss))}), '')) AS loss_sha256,
  CAST(sum(length(f)) AS BIGINT) AS formatted_chars,
  bool_and(allowed) AND bool_or(ends AND role IN {roles(template.final)}) AS valid,
  min(place) FILTER (WHERE NOT allowed) AS first_fault,
  sha256(string_agg(f, '' ORDER BY place)) AS formatted_sha256
FROM made GROUP BY conv_id
"""


ORACLE_SQL = {
    "op4_mph_line_dedup": line_dedup_sql(),
    "op6_minhash_containment": containment_sql(),
    "op12_chat_format": chat_format_sql(),
}
