"""SQL for those of the queries that SQL can express, written for DuckDB over the same tables."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def crc32(text: str) -> str:
    """CRC32 of an ASCII text, bit by bit."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    step = "CASE WHEN xor(a, b) & 1 = 1 THEN xor(xor(a, b) >> 1, 3988292384) ELSE xor(a, b) >> 1 END"
    return f"xor(list_reduce({bits}, lambda a, b: {step}, 4294967295::BIGINT), 4294967295)"


def _digest(fields: list[str]) -> str:
    field = "coalesce(strlen(({0})::VARCHAR) || ':' || ({0})::VARCHAR, '-')"
    return "sha256(" + " || ".join(field.format(f) for f in fields) + ")"


def _levels(name: str, levels: int) -> str:
    """CTEs name0 (given: tree, i, h) up to name<levels>, each with the nodes of a level, and their number."""
    out = [f"{name}0n AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}0)"]
    for k in range(levels):
        out.append(f"""{name}{k + 1}n AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM (
            SELECT tree, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {name}{k}n WHERE n > 1 GROUP BY tree, i // 16))""")
    return ",\n".join(out)


def _walk(name: str, nodes: str, levels: int) -> str:
    """CTEs name0 (given: leaf, tree, i, cur, proof) up to name<levels>, one level higher each."""
    return ",\n".join(f"""{name}{k + 1} AS (SELECT w.leaf_no, w.tree, any_value(w.i) // 16 AS i,
            coalesce(sha256(string_agg(CASE WHEN l.i = w.i THEN w.cur ELSE l.h END, '' ORDER BY l.i)), any_value(w.cur)) AS cur,
            any_value(w.proof) || coalesce(string_agg(l.h, '' ORDER BY l.i) FILTER (l.i <> w.i), '') AS proof
        FROM {name}{k} w LEFT JOIN {nodes}{k}n l ON l.tree = w.tree AND l.i // 16 = w.i // 16 AND l.n > 1 GROUP BY w.leaf_no, w.tree)"""
        for k in range(levels))


def manifest(levels: int = 4) -> str:
    """For trees of up to 16^levels leaves."""
    fields = ["doc_id", "source", "lang", "n_chars"]
    roots = " UNION ALL ".join(f"SELECT tree, h FROM leaf{k}n WHERE n = 1" for k in range(levels + 1))
    top = " UNION ALL ".join(f"SELECT h FROM upper{k}n WHERE n = 1" for k in range(levels + 1))
    return f"""WITH docs AS (SELECT *, coalesce('=' || source, '') AS tree, {_digest([*fields, 'text'])} AS h,
            CASE WHEN {crc32('doc_id::VARCHAR')} % 5 = 0 THEN {LOWER.format('text')} ELSE text END AS claimed FROM documents),
        placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
            row_number() OVER () AS leaf_no, {_digest([*fields, 'claimed'])} AS claim FROM docs),
        leaf0 AS (SELECT tree, i, h FROM placed), {_levels('leaf', levels)},
        roots AS ({roots}),
        upper0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY r.tree) - 1 AS i, h, r.tree AS below FROM roots r), {_levels('upper', levels)},
        top AS ({top}),
        walk0 AS (SELECT leaf_no, tree, i, claim AS cur, '' AS proof FROM placed), {_walk('walk', 'leaf', levels)},
        climb0 AS (SELECT w.leaf_no, '' AS tree, u.i, w.cur, w.proof FROM walk{levels} w JOIN upper0 u ON u.below = w.tree), {_walk('climb', 'upper', levels)}
        SELECT p.doc_id, p.h AS leaf, r.h AS subroot, top.h AS root, sha256(c.proof) AS proof_sha256, c.cur AS folded_root, c.cur = top.h AS verified
        FROM placed p JOIN roots r ON r.tree = p.tree JOIN climb{levels} c ON c.leaf_no = p.leaf_no CROSS JOIN top"""


PHRASES = rf"""WITH texts AS (SELECT coalesce(lang, 'und') AS lang, {LOWER.format("coalesce(text, '')")} AS text FROM documents),
        pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
        lists AS (SELECT row_number() OVER () AS no, lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
        words AS (SELECT no, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM lists),
        following AS (SELECT lang, w1, lead(w1, 1) OVER (PARTITION BY no ORDER BY i) AS w2, lead(w1, 2) OVER (PARTITION BY no ORDER BY i) AS w3 FROM words),
        grams AS (SELECT lang, 1 AS k, w1 AS phrase FROM following UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM following WHERE w2 IS NOT NULL
            UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM following WHERE w3 IS NOT NULL),
        f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
        candidates AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
        cuts AS (SELECT c.*, cut, head.n AS l, rest.n AS r, (1000000::HUGEINT * a * a) // (head.n::HUGEINT * rest.n) AS score
            FROM candidates c JOIN (VALUES (1), (2)) AS t(cut) ON cut < k
            JOIN f head ON head.lang = c.lang AND head.phrase = array_to_string(w[:cut], ' ')
            JOIN f rest ON rest.lang = c.lang AND rest.phrase = array_to_string(w[cut + 1:], ' ')),
        best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        longer AS (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM candidates WHERE k = 3),
        held AS (SELECT lang, phrase, max(a) AS most FROM longer GROUP BY ALL),
        totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        kept AS (SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase WHERE h.most IS NULL OR 100 * h.most < 50 * b.a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

ORACLES = {"op11_manifest_layout": manifest(), "op12_phrase_index": PHRASES}
