"""DuckDB SQL for the operators that SQL can express, written as plain joins over the same tables."""

from . import vector_codes


def _assigned(book: str) -> str:
    """Index and squared distance of the nearest entry of `book` for every part; whole numbers in doubles are exact."""
    apart = ("list_inner_product(a.part, a.part) - 2 * list_inner_product(a.part, b.part) "
             "+ list_inner_product(b.part, b.part)")
    return (f"SELECT rid, p, any_value(a.part) AS part, arg_min(entry, ({apart}, entry)) AS entry, min({apart}) AS apart "
            f"FROM parts a JOIN {book} b USING (p) GROUP BY rid, p")


def _moved(near: str, book: str) -> str:
    """Every entry replaced by floor(sum / count) of its parts; unused entries stay."""
    whole = "(s - ((s % n) + n) % n) // n"
    return (f"SELECT p, entry, coalesce(m.part, b.part) AS part FROM {book} b LEFT JOIN ("
            f"SELECT p, entry, list(CAST({whole} AS DOUBLE) ORDER BY i) AS part FROM ("
            f"SELECT p, entry, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT p, entry, unnest(part) AS x, "
            f"generate_subscripts(part, 1) AS i FROM {near}) GROUP BY ALL) GROUP BY ALL) m USING (p, entry)")


def vector_codes_sql() -> str:
    parts, entries, scale = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.SCALE
    steps = [
        "kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, "
        f"[floor({scale} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings "
        "WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)",
        f"parts AS MATERIALIZED (SELECT rid, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS part "
        f"FROM kept, range({parts}) t(p))",
        f"book0 AS (SELECT p, rid - 1 AS entry, part FROM parts WHERE rid <= {entries})",
    ]
    for i in range(vector_codes.ROUNDS + 1):
        steps.append(f"near{i} AS MATERIALIZED ({_assigned(f'book{i}')})")
        if i < vector_codes.ROUNDS:
            steps.append(f"book{i + 1} AS MATERIALIZED ({_moved(f'near{i}', f'book{i}')})")
    last = vector_codes.ROUNDS
    return (f"WITH {', '.join(steps)}, digest AS (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, entry, i)) "
            "AS codebooks_sha256 FROM (SELECT p, entry, unnest(part) AS x, generate_subscripts(part, 1) AS i "
            f"FROM book{last})), coded AS (SELECT rid, string_agg(printf('%02x', CAST(entry AS INT)), '' ORDER BY p) AS code, "
            f"CAST(sum(apart) AS BIGINT) AS error FROM near{last} GROUP BY rid) "
            "SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 "
            "FROM coded JOIN kept USING (rid), digest")


def divergence_sql() -> str:
    upper = "".join(map(chr, range(65, 91)))
    share = lambda c, n: f"1 + (1000000000::HUGEINT * ({c} + 5)) // ({n} + 5 * v)"
    rank = "row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(text, '') AS text FROM documents),
words AS (SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT rid) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL),
grid AS MATERIALIZED (SELECT lang, source, term, coalesce(c, 0) AS c, v, sum(coalesce(c, 0)) OVER (PARTITION BY lang, source) AS total,
    {share('kept.n', 'v.n')} AS q FROM groups JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN counts USING (lang, source, term)),
shares AS MATERIALIZED (SELECT lang, source, term, c, q, {share('c', 'total')} AS p FROM grid),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b
    ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM groups a
    JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source),
more AS (SELECT lang, source, term AS item, CAST(p - q AS BIGINT) AS value FROM shares WHERE c > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST({rank} AS INT) AS rank FROM pairs
UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, CAST({rank} AS INT) AS rank FROM more) WHERE rank <= 50"""
