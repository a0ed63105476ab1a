"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from sensorloom.llm import licenses, mixing, queries, rules, spelling

_EXACT = r"""
WITH keyed AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents),
ranked AS (
  SELECT doc_id, bare,
         first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY bare) AS group_size
  FROM keyed
  WINDOW w AS (PARTITION BY bare ORDER BY length(text) DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256
FROM ranked"""

_MEASURES = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS bare,
         list_filter(string_split(text, chr(10)),
                     lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM words)),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM windows),
       (SELECT unnest([0, 1, 2]) AS k)
  WHERE n > 1 GROUP BY doc_id),
measures AS (
  SELECT doc_id, len(words) AS n_words, length(bare) AS word_chars,
         length(bare) - length(regexp_replace(bare, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         length(bare) - length(regexp_replace(bare, '\p{Lu}', '', 'g')) AS n_upper,
         len(lines) AS n_lines
  FROM words LEFT JOIN covered USING (doc_id))"""


def _rules() -> str:
    bits = " + ".join(
        f"CASE WHEN {fails} THEN {1 << bit} ELSE 0 END" for bit, (_, fails) in enumerate(rules.RULES)
    )
    base, held = rules.mask(rules.BASE), rules.mask(rules.POLICIES[rules.CURRENT])
    return f"""{_MEASURES}, bits AS (SELECT *, CAST({bits} AS BIGINT) AS failures FROM measures)
SELECT *, failures & {base} <> 0 AS base_failed, failures & {held} = 0 AS kept FROM bits"""


def _mixing() -> str:
    topics = " ".join(f"WHEN contains(text, '{mark}') THEN '{name}'" for name, mark in mixing.TOPICS)
    ctes = [
        f"""rows AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
         CASE {topics} ELSE '{mixing.OTHER_TOPIC}' END AS topic,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS tokens
  FROM (SELECT * REPLACE (coalesce(text, '') AS text) FROM documents))""",
        "cells AS (SELECT source, lang, topic, CAST(sum(tokens) AS BIGINT) AS tokens FROM rows GROUP BY ALL)",
        f"goal AS (SELECT {queries.BUDGET} * sum(tokens) AS goal FROM cells)",
    ]
    for m in mixing.MARGINS:
        ctes.append(
            f"target_{m} AS (SELECT {m}, t / sum(t) OVER () AS share FROM (SELECT {m}, "
            f"CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens), {queries.POWERS[m]}) ELSE 0 END AS t "
            f"FROM cells GROUP BY {m}))"
        )
    ctes.append(f"w0 AS (SELECT *, {queries.BUDGET} * tokens AS weight FROM cells)")
    step = 0
    for _ in range(queries.ROUNDS):
        for m in mixing.MARGINS:
            ctes.append(
                f"w{step + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN sum(weight) OVER (PARTITION BY {m}) > 0 "
                f"THEN weight * (goal * share / sum(weight) OVER (PARTITION BY {m})) ELSE 0 END AS weight) "
                f"FROM (SELECT w.*, share, goal FROM (SELECT source, lang, topic, tokens, weight FROM w{step}) w "
                f"JOIN target_{m} USING ({m}), goal))"
            )
            step += 1
        ctes.append(
            f"w{step + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, "
            f"least(weight, tokens) AS weight FROM w{step})"
        )
        step += 1
    drawn = f"CAST('0x' || substr(md5('{queries.SEED}|' || doc_id), 1, 8) AS BIGINT) / 4294967296.0"
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, source, lang, topic, r.tokens, round(p, 6) AS probability, {drawn} < p AS kept
FROM rows r JOIN (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN weight / tokens ELSE 0 END AS p
                  FROM w{step}) USING (source, lang, topic)"""


def _licenses() -> str:
    known = ", ".join(f"('{licenses.plain(s)}', '{i}')" for i, s in licenses.SENTENCES.items())
    parts = "list_transform(string_split(regexp_replace({}, '[^a-z0-9\x01]+', ' ', 'g'), chr(1)), lambda x: trim(x))"
    ids = (
        "list_filter(list_transform({}, lambda part: names[list_position(plains, part)]), "
        "lambda i: i IS NOT NULL)"
    )
    held = ", ".join(
        "CASE WHEN {0} LIKE '{2}' OR {1} LIKE '{2}' THEN '{3}' END".format(
            *(f"' ' || array_to_string({c}, '  ') || ' '" for c in ("s", "l")),
            "% " + " % ".join(rule) + " %",
            licence,
        )
        for licence, rule in licenses.RULES
    )
    return rf"""
WITH known AS (SELECT list(p) AS plains, list(i) AS names FROM (VALUES {known}) AS k(p, i)),
ends AS (
  SELECT doc_id, regexp_replace(regexp_replace(lower(coalesce(text, '')), '([.!?;:])[ 	-
]+|
[ 	-
]*
',
         '' || chr(1), 'g'), '^$', '') AS t FROM documents),
cut AS (
  SELECT doc_id, {parts.format("t")} AS a, {parts.format("replace(t, chr(10), chr(1))")} AS b FROM ends),
found AS (SELECT doc_id, {ids.format("a")} AS s, {ids.format("b")} AS l FROM cut, known),
held AS (SELECT doc_id, s, l, list_filter([{held}], lambda x: x IS NOT NULL) AS h FROM found),
firsts AS (SELECT *, list_filter(h, lambda x, i: list_position(h, x) = i) AS licences FROM held)
SELECT doc_id, array_to_string(s, ' ') AS sentence_ids, array_to_string(l, ' ') AS line_ids,
       array_to_string(licences, ',') AS licences, len(licences) AS n_licences
FROM firsts"""


def _spelling() -> str:
    table = ", ".join(map(str, spelling.crc_table().tolist()))
    return rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {spelling.LEAST_LENGTH} GROUP BY ALL),
bytes AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hex FROM runs),
sums AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_transform(range(0, length(hex) // 2), lambda i: CAST('0x' || substr(hex, 2 * i + 1, 2) AS BIGINT)),
    lambda s, x: xor(([{table}])[1 + (xor(s, x) & 255)], s >> 8), CAST(4294967295 AS BIGINT))) AS h
  FROM bytes),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {spelling.DAMAGE} <> 0 THEN run
           ELSE substr(run, 1, h % length(run)) || substr(run, 2 + h % length(run)) END AS word, n FROM sums)
  WHERE length(word) >= {spelling.LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {spelling.LEAST_COUNT}),
cuts AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT word, rest FROM cuts WHERE rest IN (SELECT word FROM words)
  UNION SELECT rest, word FROM cuts WHERE rest IN (SELECT word FROM words)),
best AS (
  SELECT near.word, count(*) AS n_near, arg_min(other, (-o.n, encode(other))) AS form, max(o.n) AS form_n
  FROM near JOIN words o ON o.word = other GROUP BY near.word),
made AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN form_n >= {spelling.FORM_FACTOR} * n THEN form END AS form,
         CASE WHEN form_n >= {spelling.FORM_FACTOR} * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS at FROM made
  UNION ALL SELECT chain.word, made.form FROM chain JOIN made ON made.word = chain.at WHERE made.form IS NOT NULL)
SELECT made.word, made.form, chain.at AS root, made.n, made.n_near, made.form_n
FROM made JOIN chain USING (word) JOIN made ending ON ending.word = chain.at WHERE ending.form IS NULL"""


def _clusters() -> str:
    apart = "list_sum(list_transform(range(1, 65), lambda i: (x[i] - c.x[i]) * (x[i] - c.x[i])))"
    ctes = [
        """vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS cluster, x
  FROM vectors QUALIFY cluster < {queries.CLUSTERS})""",
    ]
    for r in range(queries.CLUSTER_ROUNDS + 1):
        ctes.append(
            f"""a{r} AS MATERIALIZED (
  SELECT row, vec_id, v.x, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT v.row, v.vec_id, v.x, c.cluster, {apart.replace("x[i] - c", "v.x[i] - c")} AS d FROM vectors v, c{r} c) v GROUP BY ALL)"""
        )
        ctes.append(
            f"""c{r + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(fresh.x, c{r}.x) AS x FROM c{r} LEFT JOIN (
    SELECT cluster, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (
      SELECT cluster, i, sum(x[i]) AS total, count(*) AS n FROM a{r}, (SELECT unnest(range(1, 65)) AS i) GROUP BY cluster, i)
    GROUP BY cluster) fresh USING (cluster))"""
        )
    last = queries.CLUSTER_ROUNDS
    return "WITH " + ",\n".join(ctes[:-1]) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{last}.x, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} USING (cluster)"""


ORACLE: dict[str, str] = {
    "op3_mixing": _mixing(),
    "op4_exact": _EXACT,
    "op5_licenses": _licenses(),
    "op7_rules": _rules(),
    "op12_clusters": _clusters(),
    "op13_spelling": _spelling(),
}
