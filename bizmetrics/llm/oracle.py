"""The operators' results in DuckDB SQL, where SQL can express them. No regex class here depends on case folding."""

from __future__ import annotations

from bizmetrics.llm import decontamination, quality_rules, secret_scan, sharding, source_divergence


def _filled(count: int) -> list[int]:
    """The lookup table by brute force: whole orders of preference, and in each turn the first slot not in a set."""
    names, slots = sharding.shard_names(count), sharding.SLOTS
    orders = []
    for name in names:
        offset, skip = sharding.preference(name, slots)
        orders.append(iter([(offset + j * skip) % slots for j in range(slots)]))
    owner: dict[int, int] = {}
    while len(owner) < slots:
        for shard, order in enumerate(orders):
            if len(owner) < slots:
                owner[next(slot for slot in order if slot not in owner)] = shard
    return [owner[slot] for slot in range(slots)]


def _sharding() -> str:
    here, grown = _filled(sharding.SHARDS), _filled(sharding.SHARDS + 1)
    return f"""
        WITH slots AS (
            SELECT doc_id, CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {sharding.SLOTS} AS INTEGER) AS slot
            FROM documents),
        filled AS (SELECT unnest(range({sharding.SLOTS}))::INTEGER AS slot, unnest({here}) AS shard, unnest({grown}) AS next_shard)
        SELECT doc_id, slot, shard, next_shard FROM slots JOIN filled USING (slot)"""


def _quality() -> str:
    stop = ", ".join(f"'{word}'" for word in quality_rules.STOP_WORDS)
    folded = f"translate(w, '{quality_rules.UPPER}', '{quality_rules.UPPER.lower()}')"

    def passed(rule: quality_rules.Rule) -> str:
        per = rule.per or "1"
        tests = [f"{rule.measure} {op} {bound} * {per}" for op, bound in ((">=", rule.low), ("<=", rule.high)) if bound is not None]
        return f"CASE WHEN NOT ({' AND '.join(tests)}) THEN '{rule.name}' END"

    failed = ", ".join(passed(rule) for rule in quality_rules.RULES)
    return rf"""
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
                   row_number() OVER () AS rid
            FROM documents),
        placed AS (
            SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
            FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM texts)),
        twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM placed) WHERE n > 1),
        covered AS (SELECT rid, count(DISTINCT i + d) AS n FROM twice, (VALUES (0), (1), (2)) AS v(d) GROUP BY rid),
        measured AS (
            SELECT doc_id, len(words) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                   len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines, length(t) - length(replace(t, '!', '')) AS n_exclamations,
                   len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines,
                   len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\x09-\x0D]*[-*•]\x20'))) AS n_bullet_lines,
                   len(list_filter(words, lambda w: {folded} IN ({stop}))) AS n_stop_words
            FROM texts LEFT JOIN covered USING (rid)),
        judged AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, concat_ws(',', {failed}) AS failed_rules
            FROM measured)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND failed_rules = '' AS kept, failed_rules, n_lines, n_stop_words
        FROM judged"""


def _secrets() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def found(pattern: str) -> str:
        """Every match of the pattern: rid, its text, and its place from the lengths of gaps and matches before it."""
        return f"""SELECT rid, m[i] AS v, list_sum([length(x) FOR x IN g[1:i]])::BIGINT + coalesce(list_sum([length(x) FOR x IN m[1:i-1]]), 0)::BIGINT AS s
            FROM (SELECT rid, g, m, unnest(range(1, len(m) + 1)) AS i
                  FROM (SELECT rid, regexp_extract_all(t, {quoted(pattern)}) AS m, string_split_regex(t, {quoted(pattern)}) AS g FROM texts
                        WHERE regexp_matches(t, {quoted(pattern)})))"""

    parts = [
        f"SELECT rid, {rank} AS k, s, s + length(v) AS e FROM ({found(pattern)}) WHERE length(regexp_extract(v, {quoted(pattern)}, {group})) >= {least}"
        for rank, (_, pattern, group, least) in enumerate(secret_scan.BASE)
    ]
    window = secret_scan.WINDOW
    weights = ", ".join(f"({c}, {secret_scan.weight(c)})" for c in range(1, window + 1))
    for i, cls in enumerate(secret_scan.CLASSES):
        tests = [f"length(v) >= {window}"] + ([f"regexp_matches(v, {quoted(cls.must_hold)})"] if cls.must_hold else [])
        words = quoted(secret_scan.ALLOWED_WORDS)
        # The parts of runs between allowed words.
        candidates = f"""SELECT rid, g[i] AS v, s + coalesce(list_sum([length(x) FOR x IN g[1:i-1]]), 0)::BIGINT + coalesce(list_sum([length(x) FOR x IN m[1:i-1]]), 0)::BIGINT AS s
            FROM (SELECT *, unnest(range(1, len(g) + 1)) AS i
                  FROM (SELECT rid, s, string_split_regex(v, {words}) AS g, regexp_extract_all(v, {words}) AS m
                        FROM ({found(f"{cls.alphabet}{{{window},}}")}) WHERE NOT regexp_matches(v, {quoted(secret_scan.ALLOWED_RUNS)})))"""
        # Entropy window by window, from a fresh count of each.
        parts.append(f"""
            SELECT rid, {len(secret_scan.BASE) + i} AS k, min(s + w) AS s, max(s + w) + {window} AS e
            FROM (SELECT rid, s, w, sum(f) AS total
                  FROM (SELECT rid, s, w, c, count(*) AS n
                        FROM (SELECT rid, s, w, substr(v, w + p, 1) AS c
                              FROM (SELECT *, unnest(range(0, length(v) - {window - 1})) AS w
                                    FROM ({candidates}) WHERE {" AND ".join(tests)}), range(1, {window + 1}) AS r(p))
                        GROUP BY rid, s, w, c) JOIN (VALUES {weights}) AS f(n, f) USING (n)
                  GROUP BY rid, s, w)
            WHERE total <= {secret_scan.limit(cls.entropy)} GROUP BY rid, s""")
    names = ", ".join(f"'{kind}'" for kind in secret_scan.KINDS)
    counts = ", ".join(f"count(k) FILTER (k = {rank}) AS n_{kind}" for rank, (kind, *_) in enumerate(secret_scan.BASE))
    return f"""
        WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
        spans AS ({" UNION ALL ".join(parts)}),
        named AS (SELECT *, ([{names}])[k + 1] || ':' || s || ':' || e AS label FROM spans)
        SELECT doc_id, {counts},
               sha256(coalesce(string_agg(label, ',' ORDER BY s, k) FILTER (k < {len(secret_scan.BASE)}), '')) AS base_sha256,
               coalesce(string_agg(label, ',' ORDER BY s, k), '') AS spans
        FROM texts LEFT JOIN named USING (rid) GROUP BY rid, doc_id"""


def _contamination() -> str:
    size = decontamination.WINDOW
    # Only A-Z may change case, which lower() does not promise.
    lowered = r"translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({lowered.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

    def grams(table: str, keys: str) -> str:
        """Runs of ``size`` words, as text; a shorter item is one run."""
        return f"""SELECT {keys}, n, s, array_to_string(words[s:s + n - 1], ' ') AS gram
            FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS s FROM {table} WHERE len(words) >= n AND n > 0)"""

    return f"""
        WITH items AS (SELECT item_id, {words} AS words, least({size}, len({words})) AS n FROM benchmark),
        texts AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS words FROM documents),
        wanted AS (SELECT DISTINCT item_id, n, gram FROM ({grams("items", "item_id")})),
        sized AS (SELECT rid, words, n FROM texts, (SELECT DISTINCT n FROM wanted)),
        found AS (SELECT rid, item_id, s, n FROM ({grams("sized", "rid")}) JOIN wanted USING (n, gram)),
        hit AS (SELECT rid, count(DISTINCT s + d) AS n_hit FROM found, range(0, {size}) AS r(d) WHERE d < n GROUP BY rid),
        named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM found) GROUP BY rid)
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM texts LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)"""


def _groups(size: int = 3, percent: int = 85) -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
        WITH RECURSIVE texts AS (
            SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({lowered}, '[^\x20\x09-\x0D]+') AS words FROM documents),
        placed AS (SELECT rid, words, least({size}, len(words)) AS n, unnest(range(1, len(words) - least({size}, len(words)) + 2)) AS i FROM texts WHERE len(words) > 0),
        sets AS (SELECT DISTINCT rid, array_to_string(words[i:i + n - 1], ' ') AS gram FROM placed),
        sized AS (SELECT rid, count(*) AS n FROM sets GROUP BY rid),
        common AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM sets a JOIN sets b USING (gram) WHERE a.rid <> b.rid GROUP BY ALL),
        links AS (SELECT a, b FROM common JOIN sized x ON x.rid = a JOIN sized y ON y.rid = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
        reached AS (SELECT rid AS a, rid AS b FROM texts UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b),
        low AS (SELECT a AS rid, min(doc_id) AS component_id FROM reached JOIN texts ON texts.rid = b GROUP BY a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM texts LEFT JOIN sized USING (rid) JOIN low USING (rid)"""


def _warc() -> str:
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    # 5 hexadecimal digits are 4 digits of base 32.
    base32 = f"array_to_string([substr('{alphabet}', 1 + ((CAST('0x' || substr(hash, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1) FOR i IN range(32)], '')"
    return f"""
        WITH keyed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hash FROM pages),
        marked AS (SELECT *, min(page_id) OVER (PARTITION BY hash) AS first FROM keyed)
        SELECT page_id, payload_bytes, {base32} AS payload_digest,
               CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to
        FROM marked"""


def _divergence() -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def share(count: str, total: str) -> str:
        return f"1 + (({source_divergence.SCALE}::HUGEINT * ({count} + 2)) // ({total} + 2 * v))"

    def f(p: str, q: str) -> str:
        return f"(({p} - {q}) * ({p} - {q})) // ({p} + {q})"

    # Dense: every kept term of a language for each of its sources.
    return rf"""
        WITH texts AS (
            SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all({lowered}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
            FROM documents),
        placed AS (SELECT rid, lang, source, unnest(words) AS term FROM texts),
        kept AS (SELECT lang, term, count(*) AS n FROM placed GROUP BY lang, term HAVING count(DISTINCT rid) >= {source_divergence.MIN_DOCUMENTS}),
        langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
        counts AS (SELECT lang, source, term, count(*) AS n FROM placed JOIN kept USING (lang, term) GROUP BY ALL),
        totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
        named AS (SELECT DISTINCT lang, source FROM texts),
        shares AS (
            SELECT named.lang, named.source, kept.term, coalesce(counts.n, 0) AS n, {share("coalesce(counts.n, 0)", "coalesce(totals.total, 0)")} AS p, {share("kept.n", "langs.total")} AS q
            FROM named JOIN langs USING (lang) JOIN kept USING (lang)
            LEFT JOIN totals ON totals.lang = named.lang AND totals.source = named.source
            LEFT JOIN counts ON counts.lang = named.lang AND counts.source = named.source AND counts.term = kept.term),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum({f("a.p", "b.p")}) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
            FROM named a JOIN named b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, {f("p", "q")} FROM shares WHERE n > 0 AND p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= {source_divergence.TOP}"""


def oracle_sql() -> dict[str, str]:
    return {"op2_benchmark_decontamination": _contamination(), "op3_sharding": _sharding(), "op5_quality_rules": _quality(), "op6_secret_scans": _secrets(), "op7_warc": _warc(), "op9_minhash_near_dedup": _groups(), "op13_source_divergence": _divergence()}
