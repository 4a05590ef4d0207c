"""The registered query of each corpus operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm import conversation_repair, filter_audit, fingerprints, language_crf, near_dups, packing, pieces, pii, quality_knn, quality_rules, secrets, sharding, url_filters
from millrace.llm.common import id_remainder, read
from millrace.llm.registry import CHECKS, QUERIES, query
from millrace.session import Workspace

__all__ = ["CHECKS", "QUERIES"]


@query("op1_quality_knn")
def op1(spark, folder):
    docs = read(spark, folder, "documents").withColumn("held_out", id_remainder("doc_id", 3) == 1)
    labels = read(spark, folder, "labels").where(id_remainder("doc_id", 3) != 1)
    return quality_knn.score(docs, quality_knn.train(docs, labels), ["doc_id", "held_out"])


@query("op2_rendezvous_shards")
def op2(spark, folder):
    docs = read(spark, folder, "documents")
    out = sharding.shard(docs, sharding.even(24), sharding.even(25), Workspace(spark))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query("op4_language_crf")
def op4(spark, folder):
    docs = read(spark, folder, "documents").withColumn("held_out", id_remainder("doc_id", 4) == 2)
    model = language_crf.train(language_crf.training_rows(docs.where("NOT held_out")))
    return language_crf.predict(docs, model, ["doc_id", "held_out"])


@query("op5_weighted_sampling")
def op5(spark, folder):
    return fingerprints.edited(read(spark, folder, "documents"), Workspace(spark))


RULE_SQL = " OR ".join(f"({rule.sql})" for rule in quality_rules.RULES)


@query(
    "op6_quality_rules",
    rf"""
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
    parts AS (
        SELECT row, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
               list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
        FROM docs
    ),
    windows AS (
        SELECT row, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
        FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM parts)
    ),
    twice AS (SELECT row, i, count(*) OVER (PARTITION BY row, gram) AS n FROM windows),
    repeats AS (SELECT row, count(DISTINCT i + d) AS n FROM twice, range(3) AS r(d) WHERE n > 1 GROUP BY row),
    counts AS (
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
               (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
               len(lines) AS n_lines, len(list_distinct(words)) AS n_distinct,
               len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullets,
               len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_cut
        FROM parts LEFT JOIN repeats USING (row)
    ),
    judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT ({RULE_SQL}) AS kept
    FROM judged
    """,
)
def op6(spark, folder):
    docs = read(spark, folder, "documents")
    return quality_rules.judge(docs, quality_rules.cascade(docs))


@query("op7_super_minhash")
def op7(spark, folder):
    found = near_dups.group(read(spark, folder, "documents"), Workspace(spark), threshold=0.85)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


@query("op8_secret_scan")
def op8(spark, folder):
    found = secrets.find(read(spark, folder, "documents"), Workspace(spark))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", secrets.spans_text(F.col("found")).alias("spans"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op9_harmonic_packing")
def op9(spark, folder):
    packed = packing.pack(read(spark, folder, "documents"), packing.definition_of(tokenizer_path()), Workspace(spark))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


# Fixed values: the rules of the contract.
URL_RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}


def url_sql() -> str:
    """The filter in SQL: rules by length, then every round of the spread as a table of its own."""
    fits = "\n".join(
        f"WHEN (host = '{r.partition('/')[0]}' OR suffix(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'"
        for r in sorted(URL_RULES, key=len, reverse=True)
    )
    quoted = lambda verdict: ", ".join(f"'{r}'" for r, v in URL_RULES.items() if v == verdict)  # noqa: E731
    damping = url_filters.DAMPING
    link = url_filters.LINK.replace("'", "''")
    rounds = ",\n".join(
        f"""r{i} AS (
        SELECT way, host, sum(mass) AS mass FROM (
            SELECT way, host, mass * {1 - damping} AS mass FROM seeds
            UNION ALL SELECT e.way, e.dst, r.mass * e.share * {damping} FROM r{i - 1} r JOIN edges e ON r.way = e.way AND r.host = e.src
        ) GROUP BY way, host)"""
        for i in range(1, url_filters.ROUNDS + 1)
    )
    return rf"""
    WITH split AS (
        SELECT page_id, html, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{url_filters.UPPER}', '{url_filters.LOWER}') AS host,
               regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
        FROM (SELECT page_id, html, coalesce(url, '') AS url FROM pages)
    ),
    judged AS (SELECT *, CASE {fits} END AS rule FROM split),
    counts AS (
        SELECT host, count(*) AS n, count(*) FILTER (rule IN ({quoted("allow")})) AS a, count(*) FILTER (rule IN ({quoted("block")})) AS b
        FROM judged WHERE host <> '' GROUP BY host
    ),
    seeds AS (
        SELECT CASE WHEN 2 * a > n THEN 0 ELSE 1 END AS way, host, 1.0::DOUBLE AS mass FROM counts WHERE 2 * a > n OR 2 * b > n
    ),
    found AS (
        SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{url_filters.UPPER}', '{url_filters.LOWER}') AS dst FROM split
    ),
    links AS (SELECT src, dst, count(*) AS n FROM found WHERE src <> '' AND src <> dst GROUP BY src, dst),
    each_way AS (SELECT 0 AS way, src, dst, n FROM links UNION ALL SELECT 1, dst, src, n FROM links),
    edges AS (SELECT way, src, dst, n / sum(n) OVER (PARTITION BY way, src) AS share FROM each_way),
    r0 AS (SELECT way, host, mass * {1 - damping} AS mass FROM seeds),
    {rounds},
    bad AS (
        SELECT host FROM r{url_filters.ROUNDS} GROUP BY host
        HAVING coalesce(sum(mass) FILTER (way = 1), 0) > coalesce(sum(mass) FILTER (way = 0), 0)
    )
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ({quoted("allow")}) THEN 'allow' WHEN rule IN ({quoted("block")}) THEN 'block'
                WHEN host = '' OR host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END AS verdict
    FROM judged
    """


@query("op10_link_trust", url_sql())
def op10(spark, folder):
    return url_filters.judge(read(spark, folder, "pages"), URL_RULES, Workspace(spark))


def pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op3_piece_lattice")
def op3(spark, folder):
    return pieces.digests(read(spark, folder, "documents"), Workspace(spark), pieces_path())


@query(
    "op13_filter_matrix",
    r"""
    WITH docs AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM documents
    ),
    flags AS (
        SELECT doc_id, part, [
                len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
                100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text),
                regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)
            ] AS f,
            coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
            coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic
        FROM docs
    ),
    letters AS (SELECT unnest(range(1, 6)) AS i),
    orders AS (
        SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
    ),
    steps AS (SELECT o, array_to_string(list_transform(o, lambda x: chr((64 + x)::INT)), '') AS filter_order, unnest(range(1, 6)) AS step FROM orders),
    judged AS (
        SELECT part, filter_order, step, f[o[step]] AS fails, list_bool_or([false] || list_transform(o[1:step - 1], lambda x: f[x])) AS earlier,
               f[o[step]] AND len(list_filter(f, lambda x: x)) = 1 AS alone, good, toxic, o[step] AS letter
        FROM flags, steps
    ),
    counted AS (
        SELECT part, filter_order, step, letter, count(*) FILTER (NOT fails AND NOT earlier) AS kept, count(*) FILTER (fails AND NOT earlier) AS removed,
               count(*) FILTER (fails AND earlier) AS redundant, count(*) FILTER (alone) AS unique_fails,
               count(*) FILTER (fails AND NOT earlier AND good) AS good_lost, count(*) FILTER (fails AND NOT earlier AND toxic) AS toxic_lost
        FROM judged GROUP BY ALL
    )
    SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
    FROM counted
    """,
)
def op13(spark, folder):
    docs, space = read(spark, folder, "documents"), Workspace(spark)
    rows = filter_audit.document_rows(filter_audit.matrix(docs, space))
    return filter_audit.audit(filter_audit.masks(rows, read(spark, folder, "labels")))


def repair_sql() -> str:
    """The cheapest edits as a recursion over rows, with the least (cost, audit, text) per state of the role grammar.

    States: nothing yet (n), after a system row (s), a user row (u), an assistant row (a). CRC-32 is folded bit by bit.
    """

    def edit(state: str, cost: str, letter: str, line: str | None) -> str:
        text = f"{state}.t" if line is None else f"{state}.t || chr(10) || {line}"
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}}"

    never = "{'c': 1000000000::BIGINT, 'a': 'Z', 't': ''}"
    insert = {"u": [edit(x, "3", "I", "'user:'") for x in "nsa"], "a": [edit("u", "3", "I", "'assistant:'")]}
    wide = lambda source: f"SELECT conv_id, i, n, s, list_min([u, {', '.join(insert['u'])}]) AS u, list_min([a, {insert['a'][0]}]) AS a FROM ({source})"  # noqa: E731
    # One insertion opens a turn and the next closes it: two in one place at most.
    ready = wide(wide("SELECT * FROM walk"))
    may = lambda condition, made: f"CASE WHEN NOT gone AND {condition} THEN {made} ELSE {never} END"  # noqa: E731
    keep = lambda x, initial: may(f"r = '{initial}'", edit(x, "cut", "K", "role || ':' || text"))  # noqa: E731
    change = lambda x, role: may("true", edit(x, "cut + 3", "R", f"'{role}:' || text"))  # noqa: E731
    read = {
        "n": [edit("n", "4", "D", None)],
        "s": [edit("s", "4", "D", None), keep("n", "s")],
        "u": [edit("u", "4", "D", None), *(keep(x, "u") for x in "nsa"), *(change(x, "user") for x in "nsa")],
        "a": [edit("a", "4", "D", None), keep("u", "a"), change("u", "assistant")],
    }
    after = ", ".join(f"list_min([{', '.join(made)}]) AS {state}" for state, made in read.items())
    return rf"""
    WITH RECURSIVE plain AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS key
        FROM conversations
    ),
    hashed AS (
        SELECT *, xor(list_reduce(
            [4294967295] || flatten(list_transform(key, lambda c: [unicode(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
            lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END
        ), 4294967295) % 20 AS way FROM plain
    ),
    damaged AS (
        SELECT conv_id, turn, CASE way WHEN 4 THEN 'user' ELSE role END AS role,
               CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE way WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM hashed
    ),
    placed AS (
        SELECT *, left(role, 1) AS r, row_number() OVER w AS place, lag(left(role, 1)) OVER w AS before,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
        FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy)
    ),
    judged AS (
        SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'b' WHEN nth > 1 THEN 'd'
                       WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 't' ELSE '' END AS fault
        FROM placed
    ),
    rows AS (SELECT conv_id, place, role, r, text, fault IN ('b', 'd') AS gone, CASE fault WHEN 't' THEN 3 ELSE 0 END AS cut FROM judged),
    counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
               count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
               count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n_rows
        FROM judged GROUP BY conv_id
    ),
    walk AS (
        SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS n, {never} AS s, {never} AS u, {never} AS a FROM conversations
        UNION ALL
        SELECT w.conv_id, i + 1, {after}
        FROM ({ready}) w JOIN rows ON w.conv_id IS NOT DISTINCT FROM rows.conv_id AND rows.place = i + 1
    ),
    ends AS (
        SELECT conv_id, i, list_min([n, a]) AS best FROM ({ready})
    )
    SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit, sha256(best.t[2:]) AS repaired_sha256
    FROM ends e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id WHERE e.i = coalesce(n_rows, 0)
    """


@query("op12_glr_repair", repair_sql())
def op12(spark, folder):
    return conversation_repair.repair(read(spark, folder, "conversations"))


@query("op11_deobfuscated_pii")
def op11(spark, folder):
    return pii.find(read(spark, folder, "documents"))
