"""SQL of those queries that DuckDB can express; it runs on the same tables."""

from __future__ import annotations

#: crc32 of a text of ASCII characters, bit by bit, as DuckDB has no function for it.
CRC32 = """xor(4294967295, list_reduce(
    list_transform(string_split({0}, ''), lambda c: CAST(ord(c) AS BIGINT)),
    lambda crc, byte: list_reduce(range(8), lambda e, bit: xor(e >> 1, (e & 1) * 3988292384), xor(crc, byte)),
    CAST(4294967295 AS BIGINT)))"""

ARCHIVED_PAGES = """
WITH payloads AS (
    SELECT page_id, url, coalesce(html, '') AS payload FROM pages
), ranked AS (
    SELECT *, strlen(payload) AS n,
           row_number() OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS place,
           max(page_id) OVER (PARTITION BY payload) AS kept
    FROM payloads
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN n < 1000 OR place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN n >= 1000 AND place > 1 THEN kept END AS refers_to
FROM ranked
"""


def _levels(prefix: str, depth: int) -> list[str]:
    """Levels 1 to ``depth`` of the trees whose leaves are ``<prefix>0``."""
    return [
        f"""{prefix}{k + 1} AS (
    SELECT tree, number // 16 AS number, sha256(string_agg(digest, '' ORDER BY number)) AS digest, any_value(n) AS n
    FROM {prefix}{k} WHERE n > {16**k} GROUP BY tree, number // 16
)"""
        for k in range(depth)
    ]


def _steps(prefix: str, depth: int, tree: str, number: str, n: str) -> list[str]:
    """Per level the digests before and after a node among its siblings."""
    steps = []
    for k in range(depth):
        at = f"({number} // {16**k})"
        steps.append(
            f"""leaves_{prefix}{k} AS (
    SELECT l.row, string_agg(x.digest, '' ORDER BY x.number) FILTER (x.number < {at}) AS low,
           string_agg(x.digest, '' ORDER BY x.number) FILTER (x.number > {at}) AS high
    FROM leaves l JOIN {prefix}{k} x ON x.tree = {tree} AND x.number // 16 = {number} // {16 ** (k + 1)}
    WHERE {n} > {16**k} GROUP BY l.row
)"""
        )
    return steps


def document_manifest(depth: int = 5, top_depth: int = 3) -> str:
    """Leaves, roots, proofs and checks of documents, for at most 16**depth per source and 16**top_depth
    sources."""
    fields = "doc_id source lang n_chars text".split()

    def digest(text: str) -> str:
        values = [text if c == "text" else c for c in fields]
        parts = (f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(CAST({v} AS VARCHAR)) || ':' || {v} END" for v in values)
        return f"sha256({' || '.join(parts)})"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    tables = [
        f"""digests AS (
    SELECT doc_id, source, {digest('text')} AS digest,
           CASE WHEN {CRC32.format('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {digest(lowered)} ELSE {digest('text')} END AS claimed
    FROM documents
)""",
        """claims AS (
    SELECT *, row_number() OVER () AS row,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS number,
           dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
           count(*) OVER (PARTITION BY source) AS n
    FROM digests
)""",
        "a0 AS (SELECT tree, number, digest, n FROM claims)",
        *_levels("a", depth),
    ]
    roots = " UNION ALL ".join(
        f"SELECT tree, digest FROM a{k} WHERE number = 0 AND n <= {16**k} AND n > {16 ** (k - 1) if k else 0}"
        for k in range(depth + 1)
    )
    tables += [
        f"subroots AS ({roots})",
        "b0 AS (SELECT 0 AS tree, tree AS number, digest, count(*) OVER () AS n FROM subroots)",
        *_levels("b", top_depth),
        "sources AS (SELECT count(*) AS n FROM subroots)",
        "leaves AS (SELECT c.*, s.n AS trees FROM claims c, sources s)",
    ]
    tables += _steps("a", depth, "l.tree", "l.number", "l.n")
    tables += _steps("b", top_depth, "0", "l.tree", "l.trees")
    steps = [f"leaves_a{k}" for k in range(depth)] + [f"leaves_b{k}" for k in range(top_depth)]
    siblings = " || ".join(f"coalesce({s}.low, '') || coalesce({s}.high, '')" for s in steps)
    joins = " ".join(f"LEFT JOIN {s} ON {s}.row = l.row" for s in steps)
    tables.append(
        f"""fold_0 AS (
    SELECT l.*, sha256({siblings}) AS proof_sha256, l.claimed AS folded FROM leaves l {joins}
)"""
    )
    for k, s in enumerate(steps):
        tables.append(
            f"""fold_{k + 1} AS (
    SELECT f.* REPLACE (CASE WHEN s.row IS NULL THEN f.folded
                        ELSE sha256(coalesce(s.low, '') || f.folded || coalesce(s.high, '')) END AS folded)
    FROM fold_{k} f LEFT JOIN {s} s ON s.row = f.row
)"""
        )
    root = " UNION ALL ".join(
        f"SELECT digest FROM b{k} WHERE n <= {16**k} AND n > {16 ** (k - 1) if k else 0}" for k in range(top_depth + 1)
    )
    tables.append(f"tip AS ({root})")
    return (
        f"WITH {', '.join(tables)} "
        "SELECT f.doc_id, f.digest AS leaf, s.digest AS subroot, t.digest AS root, f.proof_sha256, "
        "f.folded AS folded_root, f.folded = t.digest AS verified "
        f"FROM fold_{len(steps)} f JOIN subroots s ON s.tree = f.tree CROSS JOIN tip t"
    )
