"""DuckDB SQL for the corpus queries that SQL can state."""

from __future__ import annotations

from tripforge.llm import mixing, quality, sharding

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x20\x09-\x0D]+'"
_MEASURES = "n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"

NEAR_DUPLICATES = f"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all({_LOWERED}, {_WORD}) AS words FROM documents
    ), s AS (
        SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [words]
            ELSE [words[i:i + 4] FOR i IN range(1, len(words) - 3)] END) AS shingles FROM w
    ), sized AS (SELECT doc_id, len(shingles) AS n FROM s),
    e AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
    pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
        FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
    ), links AS (
        SELECT a, b FROM pairs JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
        WHERE 100 * shared >= 75 * (x.n + y.n - shared)
    ), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (
        SELECT doc_id, doc_id AS seen FROM documents
        UNION
        SELECT reach.doc_id, b FROM reach JOIN both_ways ON a = seen
    ), roots AS (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id)
"""

_COUNTED = f"""
    WITH w AS (
        SELECT doc_id, lang, source, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), {_WORD}) AS words,
               [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, {_WORD})] AS lines
        FROM documents
    ), windows AS (
        SELECT doc_id, unnest([{{'i': i, 'w': words[i:i + 7]}} FOR i IN range(1, len(words) - 6)], recursive := true) FROM w
    ), twice AS (
        SELECT doc_id, unnest(list(i)) AS i FROM windows GROUP BY doc_id, w HAVING count(*) > 1
    ), covered AS (
        SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS place FROM twice) GROUP BY doc_id
    ), m AS (
        SELECT doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
               length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
               len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
               coalesce(covered.n, 0) AS n_repeat_words
        FROM w LEFT JOIN covered USING (doc_id)
    ), b AS (
        SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m
    )
"""


def _quality() -> str:
    value = {rule.name: rule.value.replace(" div ", " // ") for rule in quality.RULES}
    rows = " UNION ALL ".join(f"SELECT lang, source, '{name}' AS rule, {v} AS value FROM b WHERE NOT base_failed" for name, v in value.items())
    shift = f"greatest(length(bin(value)) - {quality.BITS}, 0)::INT"
    levels = []
    for name, keys in (("own", ["lang", "source"]), ("language", ["lang"]), ("whole", [])):
        group = "".join(f"{k}, " for k in keys)
        # The discrete quantile of the rounded values is the bucket at which counts reach the share.
        levels.append(
            f"{name} AS (SELECT {group}rule, count(*) AS total, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3 "
            f"FROM v GROUP BY {group}rule)"
        )
    picked = ", ".join(
        f"CASE WHEN own.total >= {quality.MIN_TEXTS} THEN own.{q} WHEN language.total >= {quality.MIN_TEXTS} "
        f"THEN language.{q} ELSE whole.{q} END AS {q}"
        for q in ("q1", "q3")
    )
    fences, inside = [], []
    for rule in quality.RULES:
        reach = f"greatest({quality.SPREADS} * (q3 - q1), {rule.margin})"
        fences.append(f"max(q3 + {reach}) FILTER (WHERE rule = '{rule.name}') AS max_{rule.name}")
        inside.append(f"{value[rule.name]} <= max_{rule.name}")
        if rule.below:
            fences.append(f"max(q1 - {reach}) FILTER (WHERE rule = '{rule.name}') AS min_{rule.name}")
            inside.append(f"{value[rule.name]} >= min_{rule.name}")
    return f"""{_COUNTED}, v AS (SELECT lang, source, rule, (value >> {shift}) << {shift} AS bucket FROM ({rows})),
    {", ".join(levels)},
    q AS (
        SELECT own.lang, own.source, own.rule, {picked}
        FROM own JOIN language ON own.rule = language.rule AND own.lang IS NOT DISTINCT FROM language.lang
        JOIN whole ON own.rule = whole.rule
    ), limits AS (SELECT lang, source, {", ".join(fences)} FROM q GROUP BY lang, source)
    SELECT doc_id, {_MEASURES}, base_failed, NOT base_failed AND coalesce({" AND ".join(inside)}, true) AS kept
    FROM b LEFT JOIN limits ON b.lang IS NOT DISTINCT FROM limits.lang AND b.source IS NOT DISTINCT FROM limits.source
    """


def _descent(tree: list[sharding.Leaf]) -> str:
    down = sharding.children(tree)

    def draw(name: str, weight: float) -> str:
        digits = sharding._BITS // 4
        u = f"(('0x' || substr(md5(key || '/{name}'), 1, {digits}))::BIGINT::DOUBLE + 1) / {float((1 << sharding._BITS) + 1)!r}"
        return f"{{'score': -ln({u}) / {weight!r}, 'name': '{name}'}}"

    def pick(node: str) -> str:
        own = down[node]
        best = f"list_min([{', '.join(draw(*x) for x in own.items())}]).name"
        if not any(child in down for child in own):
            return best
        return f"CASE {best} " + " ".join(f"WHEN '{child}' THEN {pick(child)}" for child in own) + " END"

    return f"({pick('')})::INT"


def _sharding() -> str:
    tree = sharding.balanced_tree()
    # Checksum by a table of 256 entries, one byte at a time.
    entry = "list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)"
    octets = "[('0x' || substr(h, 2 * i + 1, 2))::BIGINT FOR i IN range(length(h) // 2)]"
    return f"""
    WITH t AS (SELECT list({entry} ORDER BY i) AS crc FROM range(256) r(i)),
    d AS (
        SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, hex(encode(coalesce(text, ''))) AS h FROM documents
    ), p AS (
        SELECT doc_id, length(h) // 2 + 1 AS size,
               xor(list_reduce({octets}, lambda c, x: xor(c >> 8, crc[xor(c, x) % 256 + 1]), 4294967295), 4294967295) AS text_crc32,
               {_descent(tree)} AS shard, {_descent(sharding.grown(tree))} AS grown_shard,
               substr(md5('slot/' || key), 1, {sharding.SLOT_DIGITS}) AS bucket
        FROM d, t
    )
    SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
           row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, text_crc32, size) - 1 AS slot
    FROM p
    """


def _mixing() -> str:
    number = f"('0x' || substr(md5('{mixing.SEED}/' || coalesce(doc_id::VARCHAR, '') || '/draw/' || j), 1, {mixing._BITS // 4}))::BIGINT / {float(1 << mixing._BITS)!r}"
    return f"""
    WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    t AS (SELECT sum(n) AS docs, sum(pow(n, {mixing.POWER})) AS weights FROM n),
    r AS (SELECT source, docs * pow(n, {mixing.POWER}) / weights / n AS rate FROM n, t),
    s AS (SELECT source, rate, greatest(1, ceil(rate / {mixing.RATE_PER_DRAW}))::INT AS draws FROM r),
    c AS (
        SELECT source, k, sum(exp(k * ln(rate / draws) - rate / draws - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS upto
        FROM s, range(200) g(k)
    ), j AS (
        SELECT doc_id, documents.source, unnest(range(1, draws + 1)) AS j
        FROM documents JOIN s ON documents.source IS NOT DISTINCT FROM s.source
    ), u AS (SELECT doc_id, source, j, {number} AS u FROM j),
    drawn AS (
        SELECT doc_id, u.source, count(*) FILTER (WHERE upto <= u) AS copies
        FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source GROUP BY doc_id, u.source
    ), e AS (SELECT doc_id, source, unnest(range(1, copies + 1))::INT AS copy FROM drawn)
    SELECT doc_id, source, copy, md5('{mixing.SEED}/' || coalesce(doc_id::VARCHAR, '') || '/copy/' || copy) AS shuffle_key FROM e
    """


def _crc32(octets: str) -> str:
    """Unsigned CRC-32 of a list of bytes, by a table ``crc`` of 256 entries in scope."""
    return f"xor(list_reduce({octets}, lambda c, x: xor(c >> 8, crc[xor(c, x) % 256 + 1]), 4294967295), 4294967295)"


def _tree(name: str, base: str, levels: int) -> str:
    """CTEs that build trees over ``base`` (tree, place, digest): nodes per level, and each leaf's siblings and root."""
    ctes = [f"{name}0 AS (SELECT tree, place, digest, count(*) OVER (PARTITION BY tree) AS size FROM {base})"]
    for k in range(levels):
        ctes.append(
            f"{name}{k + 1} AS (SELECT tree, place // 8 AS place, sha256(string_agg(digest, '' ORDER BY place)) AS digest, "
            f"(any_value(size) + 7) // 8 AS size FROM {name}{k} WHERE size > 1 GROUP BY tree, place // 8)"
        )
    for k in range(levels):
        around = "OVER (PARTITION BY tree, place // 8 ORDER BY place ROWS BETWEEN {} AND {})"
        before = f"string_agg(digest, '') {around.format('UNBOUNDED PRECEDING', '1 PRECEDING')}"
        after = f"string_agg(digest, '') {around.format('1 FOLLOWING', 'UNBOUNDED FOLLOWING')}"
        ctes.append(
            f"{name}_side{k} AS (SELECT tree, place, coalesce({before}, '') AS before, coalesce({after}, '') AS after FROM {name}{k} WHERE size > 1)"
        )
    every = " UNION ALL ".join(f"SELECT tree, digest FROM {name}{k} WHERE size = 1" for k in range(levels + 1))
    ctes.append(f"{name}_roots AS ({every})")
    sides = ", ".join(f"s{k}.before AS before{k}, s{k}.after AS after{k}" for k in range(levels))
    joins = " ".join(
        f"LEFT JOIN {name}_side{k} s{k} ON s{k}.tree = l.tree AND s{k}.place = l.place // {8**k}" for k in range(levels)
    )
    ctes.append(f"{name}_paths AS (SELECT l.tree, l.place, {sides} FROM {name}0 l {joins})")
    return ", ".join(ctes)


def _merkle(levels: int = 7, upper: int = 3) -> str:
    def field(value: str) -> str:
        return f"coalesce(octet_length(encode(({value})::VARCHAR)) || ':' || ({value})::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    entry = "list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)"
    octets = "[ord(x) FOR x IN string_split(doc_id::VARCHAR, '')]"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [("p", k) for k in range(levels)] + [("q", k) for k in range(upper)]
    chain = "SELECT *, claimed AS f0 FROM joined"
    for number, (side, k) in enumerate(steps):
        chain = (
            f"SELECT *, CASE WHEN {side}b{k} IS NULL THEN f{number} ELSE sha256({side}b{k} || f{number} || {side}a{k}) END AS f{number + 1} FROM ({chain})"
        )
    proof = " || ".join(f"coalesce({side}b{k} || {side}a{k}, '')" for side, k in steps)
    named = ", ".join(f"{side}.before{k} AS {side}b{k}, {side}.after{k} AS {side}a{k}" for side, k in steps)
    return f"""
    WITH c AS (SELECT list({entry} ORDER BY i) AS crc FROM range(256) r(i)),
    d AS (
        SELECT doc_id, lang, {leaf("text")} AS leaf,
               CASE WHEN {_crc32(octets)} % 3 = 0 THEN {leaf(lowered)} ELSE {leaf("text")} END AS claimed
        FROM documents, c
    ), ranked AS (
        SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree,
               row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM d
    ), low AS (SELECT tree, place, leaf AS digest FROM ranked), {_tree("n", "low", levels)},
    high AS (SELECT 0 AS tree, tree - 1 AS place, digest FROM n_roots), {_tree("u", "high", upper)},
    joined AS (
        SELECT ranked.*, n_roots.digest AS subroot, u_roots.digest AS root, {named}
        FROM ranked JOIN n_paths p ON p.tree = ranked.tree AND p.place = ranked.place
        JOIN n_roots ON n_roots.tree = ranked.tree JOIN u_paths q ON q.place = ranked.tree - 1 CROSS JOIN u_roots
    )
    SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, f{len(steps)} AS folded_root,
           f{len(steps)} = root AS verified FROM ({chain})
    """


def _decontamination() -> str:
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return f"""
    WITH d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, {word}) AS words FROM documents),
    b AS (SELECT item_id, regexp_extract_all({_LOWERED}, {word}) AS words FROM benchmark),
    item_windows AS (
        SELECT DISTINCT item_id, unnest(CASE WHEN len(words) < 10 THEN [words] ELSE [words[i:i + 9] FOR i IN range(1, len(words) - 8)] END) AS w
        FROM b WHERE len(words) > 0
    ), sizes AS (SELECT DISTINCT len(w) AS size FROM item_windows),
    doc_windows AS (
        SELECT doc_id, size, unnest([{{'i': i, 'w': words[i:i + size - 1]}} FOR i IN range(1, len(words) - size + 2)], recursive := true)
        FROM d, sizes
    ), hits AS (SELECT doc_id, i, size, item_id FROM doc_windows JOIN item_windows USING (w)),
    covered AS (
        SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id
    ), named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, len(words) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
    """


ORACLES: dict[str, str] = {
    "op1_near_dedup": f"""{NEAR_DUPLICATES}
        SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sized JOIN roots USING (doc_id)
    """,
    "op2_quality_rules": _quality(),
    "op3_sharding": _sharding(),
    "op5_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWERED}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op9_mixed_documents": f"""
        SELECT d.*, m.copy, m.shuffle_key FROM documents d JOIN ({_mixing()}) m ON d.doc_id IS NOT DISTINCT FROM m.doc_id
    """,
    "op9_mixing": _mixing(),
    "op12_merkle_manifest": _merkle(),
    "op13_decontamination": _decontamination(),
}
