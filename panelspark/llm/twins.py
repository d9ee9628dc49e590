"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

_USABLE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP11 = f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE vec_id IS NOT NULL AND {_USABLE}
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), placed AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place, vec_id, score FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM placed WHERE place <= 5
"""


def _codes(rounds: int) -> str:
    def assigned(name: str, books: str) -> str:
        far = "list_dot_product(list_transform(list_zip(p.p, c.e), lambda z: z[1] - z[2]), list_transform(list_zip(p.p, c.e), lambda z: z[1] - z[2]))"
        return f"""{name} AS (
  SELECT vec_id, part, any_value(p) AS p, min(far) AS far, arg_min(entry, (far, entry)) AS entry
  FROM (SELECT p.vec_id, p.part, p.p, c.entry, {far} AS far FROM parts p JOIN {books} c USING (part)) GROUP BY vec_id, part
)"""

    steps = []
    for i in range(rounds):
        steps.append(assigned(f"near{i}", f"book{i}"))
        steps.append(f"""sums{i} AS (
  SELECT part, entry, list(m ORDER BY place) AS e FROM (
    SELECT part, entry, place, floor(sum(x) / count(*)) AS m
    FROM (SELECT part, entry, unnest(p) AS x, generate_subscripts(p, 1) AS place FROM near{i}) GROUP BY part, entry, place
  ) GROUP BY part, entry
), book{i + 1} AS (
  SELECT part, entry, coalesce(s.e, b.e) AS e FROM book{i} b LEFT JOIN sums{i} s USING (part, entry)
)""")
    steps.append(assigned("last", f"book{rounds}"))
    return f"""
WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE {_USABLE}
), parts AS (
  SELECT vec_id, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS p FROM whole, (SELECT unnest(range(4)) AS part)
), book0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, p AS e FROM parts
  QUALIFY entry < 256
), {", ".join(steps)}, coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM last GROUP BY vec_id
), digest AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(e) AS x, generate_subscripts(e, 1) AS place FROM book{rounds})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN whole USING (vec_id), digest
"""


OP12 = _codes(4)

#: CRC-32 of a text of ASCII characters: eight steps a byte.
_CRC = """xor(list_reduce(
    list_concat([4294967295], flatten(list_transform(string_split({0}, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: xor(xor(a, greatest(b, 0)) >> 1, 3988292384 * (xor(a, greatest(b, 0)) & 1))), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(CAST(octet_length(encode(CAST({value} AS VARCHAR))) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _climb(name: str, leaves: str, levels: int) -> list[str]:
    """From (g, r, n, h): the nodes of each level with what is left and right of them in their run."""
    ctes = [f"{name}0 AS ({leaves})"]
    for k in range(levels + 1):
        run = "PARTITION BY g, r // 16 ORDER BY r ROWS BETWEEN"
        ctes.append(f"""{name}side{k} AS (
  SELECT g, r, n, h, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
    coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt FROM {name}{k}
)""")
        ctes.append(f"""{name}{k + 1} AS (
  SELECT g, r // 16 AS r, (max(n) + 15) // 16 AS n, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE max(h) END AS h
  FROM {name}{k} GROUP BY g, r // 16
)""")
    return ctes


def _fold(acc: str, side: str) -> str:
    return f"CASE WHEN {side}.n > 1 THEN sha256({side}.lft || {acc} || {side}.rgt) ELSE {acc} END"


def _manifest(levels: int = 5) -> str:
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    tampered = f"CASE WHEN {_CRC.format('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {lower} ELSE text END"
    ctes = [f"""leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, {_leaf('text')} AS leaf, {_leaf(f'({tampered})')} AS other,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM documents
)"""]
    ctes += _climb("s", "SELECT g, r, n, leaf AS h FROM leaves", levels)
    ctes.append(f"crowns AS (SELECT g AS own, row_number() OVER (ORDER BY g) - 1 AS r, count(*) OVER () AS n, h FROM s{levels + 1})")
    ctes += _climb("t", "SELECT '' AS g, r, n, h FROM crowns", levels)
    steps = "SELECT l.doc_id, l.g, l.r, leaf, other AS acc, '' AS proof, c.r AS place, c.h AS subroot FROM leaves l JOIN crowns c ON c.own = l.g"
    ctes.append(f"step0 AS ({steps})")
    done = 0
    for name, group, rank in (("s", "l.g", "l.r"), ("t", "''", "l.place")):
        for k in range(levels + 1):
            ctes.append(f"""step{done + 1} AS (
  SELECT l.* REPLACE ({_fold('l.acc', 'w')} AS acc, l.proof || w.lft || w.rgt AS proof)
  FROM step{done} l JOIN {name}side{k} w ON w.g = {group} AND w.r = {rank} // {16**k}
)""")
            done += 1
    return f"""
WITH {", ".join(ctes)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root AS verified
FROM step{done}, (SELECT h AS root FROM t{levels + 1})
"""


OP13 = _manifest()
