"""DuckDB SQL for the linkage queries: the same results, by other means."""

from __future__ import annotations

from weftline.functions import keys, text
from weftline.operators.blocking import channels
from weftline.operators.models import CV_SPLITS
from weftline.operators.threshold import grid
from weftline.sources.entities import VIEW


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def sub(of: str, pattern: str, to: str) -> str:
    return f"regexp_replace({of}, {quoted(pattern)}, {quoted(to)}, 'g')"


def squeezed(of: str) -> str:
    return f"trim({sub(of, r'\s+', ' ')})"


def name_sql(of: str) -> str:
    out = sub(f"lower(strip_accents(coalesce({of}, '')))", text.DOMAIN, " ")
    out = sub(out, "[&+]", " and ")
    out = sub(out, r"[.,\-–—_/\\()\"'’`#@:;!*\[\]{}~?]", " ")
    out = sub(out, r"\b([a-z])\s+([a-z])\s+([a-z])\b", r"\1\2\3")
    out = sub(out, r"\b([a-z])\s+([a-z])\b", r"\1\2")
    out = sub(out, "|".join(text.LEGAL_SUFFIXES), " ")
    return squeezed(sub(out, r"[^a-z0-9\s]", ""))


def address_sql(of: str) -> str:
    out = sub(f"lower(strip_accents(coalesce({of}, '')))", r"[,;:\-./]", " ")
    for short, word in text.ADDRESS_WORDS.items():
        out = sub(out, rf"\b{short}\b", word)
    return squeezed(sub(out, r"[^a-z0-9\s]", " "))


def country_sql(of: str) -> str:
    bare = f"trim(lower(strip_accents(coalesce({of}, ''))))"
    cases = " ".join(f"WHEN {bare} IN {listed(spellings)} THEN {quoted(name)}" for name, spellings in text.COUNTRIES.items())
    return f"CASE WHEN coalesce({of}, '') = '' THEN 'unknown' {cases} ELSE {bare} END"


def numbers_sql(of: str) -> str:
    bare = f"list_transform(regexp_extract_all(coalesce({of}, ''), '[0-9]+'), lambda x: ltrim(x, '0'))"
    return distinct_sql(f"list_filter({bare}, lambda x: length(x) BETWEEN 1 AND 8)")


def distinct_sql(of: str) -> str:
    """Distinct values in the order of their first places."""
    return f"list_filter({of}, lambda x, i: list_position({of}, x) = i)"


def words_sql(of: str) -> str:
    return f"list_filter(string_split({of}, ' '), lambda x: x <> '')"


def sound_sql(word: str, steps: tuple[tuple[str, str], ...]) -> str:
    out = f"lower({word})"
    for letter in "abcdefghijklmnopqrstuvwxyz0123456789":
        out = sub(out, letter * 2 + "+", letter)
    out = f"list_transform([{out}], lambda r: CASE WHEN r LIKE '%e' AND length(r) > 2 THEN substr(r, 1, length(r) - 1) ELSE r END)[1]"
    for old, new in steps:
        out = sub(out, old, new)
    return f"list_transform([{out}], lambda r: substr(r, 1, 1) || {sub('substr(r, 2)', '[aeiou]', '')})[1]"


RECORDS = (
    "WITH entities AS ("
    + VIEW.format(part="part", string="VARCHAR")
    + f"), records AS (SELECT entity_id, src, k, ent, is_true_link, business_name, business_address, country, {name_sql('business_name')} AS norm_name,"
    + f" {address_sql('business_address')} AS norm_address, {country_sql('country')} AS norm_country FROM entities)"
)

TELLING = f"lambda w: length(w) >= 3 AND w NOT IN {listed(keys.STOPWORDS)}"
KEYS = (
    RECORDS
    + f", k0 AS (SELECT *, list_filter({words_sql('norm_name')}, lambda w: w NOT IN {listed(keys.LEGAL_TOKENS)}) AS content, {numbers_sql('norm_address')} AS nums,"
    + f" list_filter(regexp_extract_all(norm_address, '\\b[a-z]{{3,}}\\b'), lambda w: w NOT IN {listed(keys.ADDRESS_STOPWORDS)}) AS streets FROM records),"
    + " k1 AS (SELECT *, CASE WHEN len(content) = 0 THEN norm_name ELSE array_to_string(content, ' ') END AS core FROM k0),"
    + f" keyed AS (SELECT *, {words_sql('core')} AS words, replace(core, ' ', '') AS spaceless, substr(core, 1, 3) AS prefix,"
    + f" list_filter({words_sql('core')}, {TELLING}) AS telling, list_filter({words_sql('core')}, lambda w: w NOT IN {listed(keys.LEGAL_TOKENS)}) AS legal_free FROM k1)"
)
PHONETIC = f"array_to_string(list_transform(list_filter({words_sql('norm_name')}, lambda w: w NOT IN {listed(keys.LEGAL_TOKENS)} AND length(w) >= 2)[1:3], lambda w: {sound_sql('w', (('ck|qu', 'k'), ('ph', 'f'), ('th', '0')))}), '_')"
METAPHONE = f"array_to_string(list_transform(list_filter({words_sql('norm_name')}, lambda w: w NOT IN {listed(keys.LEGAL_TOKENS)} AND length(w) >= 2)[1:3], lambda w: {sound_sql('w', (('ck', 'k'), ('ph', 'f'), ('sch', 'sk'), ('th', '0'), ('qu', 'k')))}), ' ')"


def one_sql(value: str, keep: str) -> str:
    return f"CASE WHEN {keep} THEN [{value}] ELSE [] END"


def word_sql(of: str) -> str:
    return one_sql(of, f"length({of}) >= 3 AND {of} NOT IN {listed(keys.STOPWORDS)}")


def key_lists(target: bool) -> list[str]:
    grams = "CASE WHEN length(core) = 0 THEN [] WHEN length(core) < 4 THEN [core] ELSE list_transform(generate_series(1, length(core) - 3), lambda i: substr(core, CAST(i AS INT), 4)) END"
    pins = "list_filter(nums[2:], lambda n: length(n) IN (5, 6))"
    pins = pins if target else f"({pins})[1:1]"
    named = [
        one_sql("norm_name", "norm_name <> ''"),
        one_sql("core", "core <> norm_name AND length(core) >= 3" if target else "core <> ''"),
        one_sql("array_to_string(list_sort(words), ' ')", "len(words) > 1"),
        one_sql("array_to_string(words[1:2], ' ')", "len(words) > 1"),
        one_sql("spaceless", "length(spaceless) >= 3"),
        word_sql("words[1]"),
        word_sql("legal_free[-1]"),
        "telling",
        one_sql("array_to_string(telling[1:2], '_')", "len(telling) >= 2"),
        one_sql("phonetic", "phonetic <> ''"),
        f"({grams})[1:6]",
        "list_transform(nums, lambda n: prefix || '_' || n)",
        "list_transform(list_filter(streets[1:3], lambda w: length(w) >= 4), lambda w: prefix || '_' || w)",
    ]
    return [f"CASE WHEN norm_name <> '' THEN {n} ELSE [] END" for n in named] + [
        one_sql("nums[1] || '_' || nums[2]", "len(nums) >= 2"),
        "flatten(list_transform(nums[1:2], lambda n: list_transform(streets[1:3], lambda w: n || '_' || w)))",
        "list_filter(nums, lambda n: length(n) >= 5)",
        f"list_transform({pins}, lambda n: nums[1] || '_' || n)",
    ]


def exploded_sql(target: bool, only: tuple[int, ...]) -> str:
    where = "src <> 1" if target else "src = 1"
    lists = key_lists(target)
    return " UNION ALL ".join(f"SELECT entity_id, src, k, norm_country, {n} AS channel, unnest(CAST({lists[n - 1]} AS VARCHAR[])) AS key, generate_subscripts(CAST({lists[n - 1]} AS VARCHAR[]), 1) AS pos FROM named WHERE {where}" for n in only)


def hits_sql(only: tuple[int, ...] = tuple(range(1, 18))) -> str:
    bound = " ".join(f"WHEN {c.number} THEN {min(c.postings, c.hits)}" for c in channels())
    weight = " ".join(f"WHEN {c.number} THEN {c.weight}" for c in channels())
    return (
        KEYS
        + f", named AS (SELECT *, {PHONETIC} AS phonetic FROM keyed), t AS ({exploded_sql(True, only)}), q AS ({exploded_sql(False, only)}),"
        + " ranked AS (SELECT *, row_number() OVER (PARTITION BY norm_country, channel, key ORDER BY src, k, pos) AS rk FROM t),"
        + f" lists AS (SELECT * FROM ranked WHERE rk <= CASE channel {bound} END),"
        + f" hits AS (SELECT q.entity_id AS s1_id, lists.entity_id AS target_id, q.channel, q.pos, lists.rk, CASE q.channel {weight} END AS weight FROM q JOIN lists USING (norm_country, channel, key))"
    )


def votes_sql() -> str:
    touch = "CAST(channel AS BIGINT) * 1000000000 + pos * 1000 + rk"
    return (
        hits_sql()
        + f", summed AS (SELECT s1_id, target_id, coalesce(sum(weight) FILTER (channel <> 11), 0) AS plain, count(*) FILTER (channel = 11) AS grams, min({touch}) FILTER (channel <> 11) AS f0, min({touch}) FILTER (channel = 11) AS f1 FROM hits GROUP BY ALL),"
        + " votes AS (SELECT s1_id, target_id, CAST(plain + CASE WHEN grams >= 2 THEN least(grams, 3) ELSE 0 END AS BIGINT) AS votes, least(f0, CASE WHEN grams >= 2 THEN f1 END) AS touch FROM summed),"
        + " candidates AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY votes DESC, touch) AS rank FROM votes WHERE votes > 0) WHERE rank <= 100),"
        + " truth AS (SELECT a.entity_id AS s1_id, b.entity_id AS target_id FROM records a JOIN records b ON a.ent = b.ent AND a.src = 1 AND b.is_true_link)"
    )


def common_sql(a: str, b: str) -> str:
    """Length of the longest common subsequence of two strings of at most 61 letters, by bit sets."""
    full = f"(CAST(1 AS BIGINT) << length({a})) - 1"
    mask = f"coalesce(list_sum(list_transform(generate_series(1, length({a})), lambda i: CASE WHEN substr({a}, CAST(i AS INT), 1) = c.x THEN CAST(1 AS BIGINT) << CAST(i - 1 AS INT) ELSE 0 END))::BIGINT, 0)"
    steps = f"list_transform(generate_series(1, length({b})), lambda j: {{'x': substr({b}, CAST(j AS INT), 1), 'v': CAST(0 AS BIGINT)}})"
    state = f"list_reduce({steps}, lambda s, c: {{'x': '', 'v': ((s.v + (s.v & ({mask}))) | (s.v & ~({mask}))) & ({full})}}, {{'x': '', 'v': {full}}})"
    return f"(CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE bit_count(xor(({state}).v, {full})) END)"


def ratio_sql(a: str, b: str) -> str:
    return f"CASE WHEN length({a}) + length({b}) = 0 THEN 1.0 ELSE 2.0 * {common_sql(a, b)} / (length({a}) + length({b})) END"


def jaccard_sql(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    either = f"(len({a}) + len({b}) - {both})"
    return f"CASE WHEN {either} = 0 THEN 1.0 ELSE {both} * 1.0 / {either} END"


def grams_sql(of: str, n: int) -> str:
    return f"list_distinct(CASE WHEN length({of}) = 0 THEN [] WHEN length({of}) < {n} THEN [{of}] ELSE list_transform(generate_series(1, length({of}) - {n - 1}), lambda i: substr({of}, CAST(i AS INT), {n})) END)"


def pairs_sql() -> str:
    profile = (
        f"SELECT entity_id, norm_name AS name, norm_address AS addr, norm_country AS country, list_distinct({words_sql('norm_name')}) AS words, {grams_sql('norm_name', 3)} AS g3, {grams_sql('norm_name', 4)} AS g4,"
        f" coalesce({words_sql('norm_name')}[1], '') AS first_word, coalesce(content[-1], '') AS last_word, {numbers_sql('business_address')} AS geos,"
        " list_transform(regexp_extract_all(norm_address, '[0-9]+'), lambda x: ltrim(x, '0')) AS runs,"
        f" list_distinct({words_sql('norm_address')}) AS addr_words, list_distinct({words_sql(METAPHONE)}) AS sounds FROM keyed"
    )
    return (
        votes_sql()
        + f", profiles AS ({profile}), pairs AS (SELECT c.s1_id, c.target_id, l.name AS ln, r.name AS rn, l.addr AS la, r.addr AS ra, l.words AS lw, r.words AS rw, l.g3 AS lg3, r.g3 AS rg3, l.g4 AS lg4, r.g4 AS rg4,"
        + " l.first_word AS lf, r.first_word AS rf, l.last_word AS ll, r.last_word AS rl, l.geos AS lgeo, r.geos AS rgeo, coalesce(l.runs[1], '') AS l1, coalesce(r.runs[1], '') AS r1,"
        + " list_distinct(list_filter(l.runs, lambda x: x <> '')) AS ls, list_distinct(list_filter(r.runs, lambda x: x <> '')) AS rs, l.addr_words AS law, r.addr_words AS raw_, l.sounds AS lso, r.sounds AS rso, l.country AS lc, r.country AS rc"
        + " FROM candidates c JOIN profiles l ON c.s1_id = l.entity_id JOIN profiles r ON c.target_id = r.entity_id)"
    )


def set_ratio_ctes(name: str, a: str, b: str) -> str:
    """CTEs that end in `name` (s1_id, target_id, v): the token set ratio of two lists without repeats."""
    joined = "array_to_string(list_sort({}), ' ')"
    left, right = f"list_filter({a}, lambda x: NOT list_contains({b}, x))", f"list_filter({b}, lambda x: NOT list_contains({a}, x))"
    return (
        f"{name}_0 AS (SELECT s1_id, target_id, len({a}) = 0 OR len({b}) = 0 AS none, length({joined.format(f'list_intersect({a}, {b})')}) AS n, {joined.format(left)} AS x, {joined.format(right)} AS y FROM pairs),"
        f" {name}_1 AS (SELECT *, length(x) AS nx, length(y) AS ny, CASE WHEN n > 0 THEN 1 ELSE 0 END AS sep, CASE WHEN NOT none AND NOT (n > 0 AND (x = '' OR y = '')) THEN {common_sql('x', 'y')} ELSE 0 END AS c FROM {name}_0),"
        f" {name} AS (SELECT s1_id, target_id, CASE WHEN none THEN 0.0 WHEN n > 0 AND (nx = 0 OR ny = 0) THEN 1.0 ELSE greatest(1 - (nx + ny - 2 * c) * 1.0 / (2 * n + 2 * sep + nx + ny),"
        " CASE WHEN n > 0 THEN 1 - (sep + nx) * 1.0 / (2 * n + sep + nx) ELSE 0 END, CASE WHEN n > 0 THEN 1 - (sep + ny) * 1.0 / (2 * n + sep + ny) ELSE 0 END) END AS v"
        f" FROM {name}_1)"
    )


def scored_sql() -> str:
    """The deterministic score of the threshold queries: mean of the word Jaccards of name and address."""
    return pairs_sql() + f", scored AS (SELECT s1_id, target_id, round((({jaccard_sql('lw', 'rw')}) + ({jaccard_sql('law', 'raw_')})) / 2, 9) AS prob FROM pairs), s1 AS (SELECT entity_id AS s1_id FROM records WHERE src = 1)"


def judged_sql(said: str) -> str:
    """CTEs that end in `judged` (s1_id, n_pred, n_true, tp, f05) for the predictions in `said`."""
    return (
        f", pr AS (SELECT s1_id, count(*) AS n_pred FROM {said} GROUP BY 1), tr AS (SELECT s1_id, count(*) AS n_true FROM truth GROUP BY 1), ht AS (SELECT s1_id, count(*) AS tp FROM {said} JOIN truth USING (s1_id, target_id) GROUP BY 1),"
        " counted AS (SELECT s1_id, coalesce(n_pred, 0) AS n_pred, coalesce(n_true, 0) AS n_true, coalesce(tp, 0) AS tp FROM s1 LEFT JOIN pr USING (s1_id) LEFT JOIN tr USING (s1_id) LEFT JOIN ht USING (s1_id)),"
        f" judged AS (SELECT *, {F05} AS f05 FROM counted)"
    )


F05 = "CASE WHEN n_true = 0 THEN CASE WHEN n_pred = 0 THEN 1.0 ELSE 0.0 END WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp * 1.0 / n_pred) * (tp * 1.0 / n_true) / (0.25 * tp / n_pred + tp * 1.0 / n_true) END"
SUMMARY = (
    "round(avg(f05), 6) AS macro_f05, count(*) FILTER (n_true = 0) AS singleton_count, round(coalesce(avg(f05) FILTER (n_true = 0), 1.0), 6) AS singleton_accuracy, count(*) FILTER (n_true > 0) AS non_singleton_count,"
    " round(coalesce(avg(f05) FILTER (n_true > 0), 0.0), 6) AS non_singleton_f05, round(CASE WHEN sum(n_pred) > 0 THEN sum(tp) * 1.0 / sum(n_pred) ELSE 0.0 END, 6) AS overall_micro_precision,"
    " round(CASE WHEN sum(n_true) > 0 THEN sum(tp) * 1.0 / sum(n_true) ELSE 0.0 END, 6) AS overall_micro_recall, CAST(sum(n_pred) AS BIGINT) AS total_predictions, CAST(sum(n_true) AS BIGINT) AS total_true_links, CAST(sum(n_pred - tp) AS BIGINT) AS total_false_positives"
)
PASSED = 0.5


def sweep_sql() -> str:
    points = ", ".join(f"({p!r})" for p in grid())
    return (
        scored_sql()
        + f", g(threshold) AS (VALUES {points}), cells AS (SELECT g.threshold, s1.s1_id FROM g, s1), ok AS (SELECT threshold, s1_id, target_id FROM scored JOIN g ON prob >= threshold),"
        + " pr AS (SELECT threshold, s1_id, count(*) AS n_pred FROM ok GROUP BY ALL), ht AS (SELECT threshold, s1_id, count(*) AS tp FROM ok JOIN truth USING (s1_id, target_id) GROUP BY ALL), tr AS (SELECT s1_id, count(*) AS n_true FROM truth GROUP BY 1),"
        + " counted AS (SELECT threshold, s1_id, coalesce(n_pred, 0) AS n_pred, coalesce(n_true, 0) AS n_true, coalesce(tp, 0) AS tp FROM cells LEFT JOIN pr USING (threshold, s1_id) LEFT JOIN ht USING (threshold, s1_id) LEFT JOIN tr USING (s1_id)),"
        + f" sweep AS (SELECT round(threshold, 6) AS threshold, {SUMMARY} FROM (SELECT *, {F05} AS f05 FROM counted) GROUP BY threshold)"
    )


def findings_sql() -> str:
    """The checks over lines where source 3 has no tab and source 2 names one unknown entity."""
    cases = (
        ("malformed_row", "SELECT CAST(src * (CAST(1 AS BIGINT) << 56) + k AS VARCHAR) || ': ' || entity_id FROM records WHERE src = 3"),
        ("duplicate_row", "SELECT s1_id FROM good GROUP BY s1_id HAVING count(*) > 1"),
        ("repeated_id", "SELECT s1_id FROM good"),
        ("self_match", "SELECT id FROM ids WHERE id LIKE 'S1-%'"),
        ("wrong_prefix", "SELECT id FROM ids WHERE id NOT LIKE 'S1-%' AND id NOT LIKE 'S2-%' AND id NOT LIKE 'S3-%'"),
        ("missing_entity", "SELECT entity_id FROM records WHERE src <> 2 AND entity_id NOT IN (SELECT s1_id FROM good)"),
        ("unknown_entity", "SELECT s1_id FROM good WHERE s1_id NOT IN (SELECT entity_id FROM records WHERE src <> 2)"),
        ("unknown_id", "SELECT id FROM ids WHERE (id LIKE 'S2-%' OR id LIKE 'S3-%') AND id NOT IN (SELECT entity_id FROM records WHERE src = 3)"),
    )
    rules = " UNION ALL ".join(f"SELECT '{rule}' AS rule, x.id FROM ({sql}) x(id)" for rule, sql in cases)
    return (
        RECORDS
        + ", good AS (SELECT CASE WHEN src = 2 THEN 'S1-none' ELSE entity_id END AS s1_id, entity_id, norm_country FROM records WHERE src <> 3),"
        + f" ids AS (SELECT entity_id AS id FROM good UNION ALL SELECT norm_country FROM good), found AS (SELECT DISTINCT rule, id FROM ({rules}))"
        + " SELECT 'error' AS severity, rule, 'matching' AS file, count(*) AS n, array_to_string(list_sort(list(id))[1:5], ',') AS examples FROM found GROUP BY rule"
    )


def oracle_sql() -> dict[str, str]:
    out = {
        "norm_records": RECORDS + " SELECT entity_id, norm_name, norm_address, norm_country FROM records",
        "geo_tokens": RECORDS + f" SELECT entity_id, array_to_string({numbers_sql('business_address')}, ',') AS geos FROM records",
        "name_keys": KEYS
        + " SELECT entity_id, core, array_to_string(list_sort(words), ' ') AS sorted_tokens, spaceless AS unspaced, array_to_string(words[1:2], ' ') AS first_two, array_to_string(telling, ',') AS telling FROM keyed",
        "char_ngrams": RECORDS + " SELECT entity_id, array_to_string(list_transform(generate_series(1, length(norm_name) - 3), lambda i: substr(norm_name, CAST(i AS INT), 4)), '|') AS grams FROM records",
        "address_blocks": KEYS + " SELECT entity_id, array_to_string(nums, ',') AS nums, array_to_string(streets, ',') AS streets FROM keyed",
        "phonetic_keys": RECORDS + f" SELECT entity_id, {PHONETIC} AS phonetic, {METAPHONE} AS metaphone FROM records",
        "block_votes": votes_sql() + " SELECT s1_id, target_id, votes FROM votes WHERE votes > 0",
        "block_topk": votes_sql() + " SELECT s1_id, target_id, votes, CAST(rank AS INT) AS rank FROM candidates",
        "blocking_quality": votes_sql()
        + ", s AS (SELECT (SELECT count(*) FROM candidates JOIN truth USING (s1_id, target_id)) AS captured_links, (SELECT count(*) FROM truth) AS total_gt_links, (SELECT count(*) FROM candidates) AS total_candidates,"
        + " (SELECT count(*) FROM records WHERE src = 1) AS n1, (SELECT count(*) FROM records WHERE src <> 1) AS nt) SELECT round(captured_links * 1.0 / total_gt_links, 6) AS blocking_recall, captured_links, total_gt_links, total_candidates,"
        + " round(1 - total_candidates * 1.0 / (n1 * nt), 6) AS reduction_ratio, round(total_candidates * 1.0 / n1, 6) AS avg_candidates_per_s1 FROM s",
        "set_features": pairs_sql()
        + f" SELECT s1_id, target_id, round({jaccard_sql('lw', 'rw')}, 6) AS name_word_jaccard, round({jaccard_sql('lg3', 'rg3')}, 6) AS name_ngram_jaccard, round({jaccard_sql('lg4', 'rg4')}, 6) AS name_4gram_jaccard,"
        + f" CAST(lf = rf AND lf <> '' AS DOUBLE) AS first_word_match, CAST(ll = rl AND ll <> '' AS DOUBLE) AS last_word_match, round({jaccard_sql('law', 'raw_')}, 6) AS addr_word_jaccard, round({jaccard_sql('lgeo', 'rgeo')}, 6) AS geo_jaccard,"
        + " CAST(len(list_intersect(lgeo, rgeo)) > 0 AS DOUBLE) AS has_common_geo, CAST(len(lgeo) > 0 AND len(rgeo) > 0 AND len(list_intersect(lgeo, rgeo)) = 0 AS DOUBLE) AS contradictory_geo,"
        + f" CAST(l1 = r1 AND l1 <> '' AS DOUBLE) AS addr_first_num_match, round({jaccard_sql('ls', 'rs')}, 6) AS addr_num_jaccard, round(len(list_intersect(lw, rw)) * 1.0 / greatest(len(lw), 1), 6) AS name_containment_s1,"
        + " round(len(list_intersect(lw, rw)) * 1.0 / greatest(len(rw), 1), 6) AS name_containment_t, CAST(abs(length(ln) - length(rn)) AS DOUBLE) AS name_len_diff, round(least(length(ln), length(rn)) * 1.0 / greatest(length(ln), length(rn)), 6) AS name_len_ratio,"
        + " CAST(la = '' AS DOUBLE) AS s1_missing_addr, CAST(ra = '' AS DOUBLE) AS t_missing_addr, CAST(lc = rc AS DOUBLE) AS country_match FROM pairs",
        "string_features": pairs_sql()
        + f", {set_ratio_ctes('ns', 'lw', 'rw')}, {set_ratio_ctes('ads', 'law', 'raw_')}, {set_ratio_ctes('so', 'lso', 'rso')}, sorted AS (SELECT *, array_to_string(list_sort({words_sql('ln')}), ' ') AS lns, array_to_string(list_sort({words_sql('rn')}), ' ') AS rns FROM pairs)"
        + f" SELECT p.s1_id, p.target_id, round({ratio_sql('ln', 'rn')}, 6) AS name_ratio, round({ratio_sql('lns', 'rns')}, 6) AS name_token_sort, round({ratio_sql('la', 'ra')}, 6) AS addr_ratio,"
        + " round(CASE WHEN ln = '' AND rn = '' THEN 1.0 ELSE jaro_winkler_similarity(ln, rn) END, 6) AS name_jw, round(CASE WHEN la = '' AND ra = '' THEN 1.0 ELSE jaro_winkler_similarity(la, ra) END, 6) AS addr_jw,"
        + " round(jaro_winkler_similarity(ln || ' ' || la, rn || ' ' || ra), 6) AS full_jw, round(ns.v, 6) AS name_token_set, round(ads.v, 6) AS addr_token_set, round(so.v, 6) AS name_phonetic_sim"
        + " FROM sorted p JOIN ns USING (s1_id, target_id) JOIN ads USING (s1_id, target_id) JOIN so USING (s1_id, target_id)",
        "entity_f05": scored_sql() + f", said AS (SELECT * FROM scored WHERE prob >= {PASSED})" + judged_sql("said") + " SELECT s1_id, n_pred, n_true, tp, round(f05, 6) AS f05 FROM judged",
        "evaluate_predictions": scored_sql() + f", said AS (SELECT * FROM scored WHERE prob >= {PASSED})" + judged_sql("said") + f" SELECT {SUMMARY} FROM judged",
        "threshold_sweep": sweep_sql() + " SELECT * FROM sweep",
        "best_threshold": sweep_sql() + " SELECT * FROM sweep ORDER BY macro_f05 DESC, threshold LIMIT 1",
        "apply_threshold": scored_sql()
        + f", top AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY prob DESC, target_id) AS rank FROM scored WHERE prob >= {PASSED}), chosen AS (SELECT s1_id, string_agg(target_id, ',' ORDER BY rank) AS matched_ids FROM top WHERE rank <= 10 GROUP BY 1)"
        + " SELECT s1_id, coalesce(matched_ids, '') AS matched_ids FROM s1 LEFT JOIN chosen USING (s1_id)",
        "eda_missing": RECORDS
        + " SELECT src, count(*) AS total_rows, count(*) FILTER (trim(business_name) = '') AS missing_name, count(*) FILTER (trim(business_address) = '') AS missing_address, count(*) FILTER (trim(country) = '') AS missing_country,"
        + " round(count(*) FILTER (trim(business_address) = '') * 100.0 / count(*), 6) AS missing_address_pct FROM records GROUP BY src",
        "eda_lengths": RECORDS
        + ", w AS (SELECT src, length(business_name) AS nc, len(list_filter(regexp_split_to_array(trim(business_name), '\\s+'), lambda x: x <> '')) AS nw, length(business_address) AS ac, len(list_filter(regexp_split_to_array(trim(business_address), '\\s+'), lambda x: x <> '')) AS aw FROM records)"
        + " SELECT src, "
        + ", ".join(f"round(avg({c}), 6) AS {n}_mean, CAST(min({c}) AS BIGINT) AS {n}_min, CAST(max({c}) AS BIGINT) AS {n}_max" for c, n in (("nc", "name_chars"), ("nw", "name_words"), ("ac", "address_chars"), ("aw", "address_words")))
        + " FROM w GROUP BY src",
        "eda_countries": RECORDS + " SELECT src, country, count(*) AS n FROM records GROUP BY ALL",
        "eda_duplicates": RECORDS + " SELECT src, count(*) - count(DISTINCT norm_name) AS dup_names, count(*) - count(DISTINCT norm_name || chr(1) || norm_address) AS dup_pairs FROM records GROUP BY src",
        "eda_top_tokens": RECORDS + f", t AS (SELECT unnest({words_sql('norm_name')}) AS token FROM records) SELECT token, count(*) AS n FROM t GROUP BY token ORDER BY n DESC, token LIMIT 10",
        "eda_overlap": RECORDS
        + ", n AS (SELECT norm_name, bool_or(src = 1) AS a, bool_or(src = 2) AS b, bool_or(src = 3) AS c FROM records WHERE norm_name <> '' GROUP BY 1) SELECT count(*) AS s1_names, count(*) FILTER (b) AS in_s2, count(*) FILTER (c) AS in_s3, count(*) FILTER (b OR c) AS in_either FROM n WHERE a",
        "match_histogram": RECORDS
        + ", n AS (SELECT a.entity_id, count(b.entity_id) AS n_matches FROM records a LEFT JOIN records b ON a.ent = b.ent AND b.is_true_link WHERE a.src = 1 GROUP BY 1) SELECT n_matches, count(*) AS entities FROM n GROUP BY 1",
        "link_summary": RECORDS
        + ", n AS (SELECT a.entity_id, count(b.entity_id) AS n, count(*) FILTER (b.src = 2) AS n2, count(*) FILTER (b.src = 3) AS n3 FROM records a LEFT JOIN records b ON a.ent = b.ent AND b.is_true_link WHERE a.src = 1 GROUP BY 1)"
        + " SELECT count(*) AS total_s1, count(*) FILTER (n = 0) AS singletons, CAST(sum(n) AS BIGINT) AS total_matches, CAST(sum(n2) AS BIGINT) AS s2_matches, CAST(sum(n3) AS BIGINT) AS s3_matches, round(count(*) FILTER (n = 0) * 1.0 / count(*), 6) AS singleton_rate FROM n",
    }
    out["group_folds"] = RECORDS + f" SELECT entity_id AS s1_id, CAST(CAST('0x' || substr(md5(entity_id), 1, 8) AS BIGINT) % {CV_SPLITS} AS INT) AS fold FROM records WHERE src = 1"
    out["validation_findings"] = findings_sql()
    for c in channels():
        out[f"block_{c.name}"] = hits_sql((c.number,)) + " SELECT s1_id, target_id, CAST(sum(weight) AS BIGINT) AS votes FROM hits GROUP BY ALL"
    return out
