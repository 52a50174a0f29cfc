"""The registered queries of the corpus operators, and their SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.llm import bpe, chat, decontaminate, linededup, lm, neardup, phrases, quality, runs, secrets, sharding, toxicity, warc
from tabsmith.llm.common import stage, table, text_or_empty

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


def tokenizer_path() -> str:
    """The vocabulary file that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: A-Z to a-z in DuckDB.
SQL_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op1_sharding")
def op1_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty()).alias("text_crc32"))
    placed = sharding.assign(stage(docs, "sizes"), "doc_id", shards=16, ties=["size", "text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op2_lm_scoring")
def op2_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm.train_and_score(docs)
    return scored.select(
        "doc_id", lm.held_out("doc_id", 10).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op3_bpe")
def op3_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, tokenizer_path()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out("doc_id", 5).alias("held_out"), "score", "predicted")


@query("op5_line_dedup", f"""
    with docs as (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
    lines as (select doc_id, parts[i] as line, i from (select doc_id, parts, unnest(range(1, len(parts) + 1)) as i from docs)),
    keyed as (
        select doc_id, i, line,
            {SQL_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as k
        from lines),
    shared as (
        select k, max(doc_id) as holder from keyed where length(k) >= 20 group by k having count(distinct doc_id) >= 3),
    judged as (
        select keyed.doc_id, i, line, shared.k is not null and keyed.doc_id <> shared.holder as gone
        from keyed left join shared on keyed.k = shared.k)
    select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
        sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
    from judged group by doc_id""")
def op5_line_dedup(spark, sf_dir):
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text_or_empty(), 256).alias("kept_sha256"))


_SQL_WORDS = "regexp_extract_all(" + SQL_LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op6_quality_rules")
def op6_quality_rules(spark, sf_dir):
    found = quality.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.drop("text", "lang")


def _sql_spans(rule: secrets.Rule) -> str:
    """Rows (doc_id, rule, kind, s, e, value) of all matches of a rule."""
    pattern, flag = rule.pattern.replace("'", "''"), "'i'" if rule.any_case else "''"
    prefix = "(?i)" if rule.any_case else ""
    order = secrets.RULES.index(rule)
    return f"""
        select doc_id, {order} as rule, '{rule.kind}' as kind, s, s + length(hits[i]) as e, vals[i] as val from (
            select *, cast(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) as bigint) as s
            from (select *, unnest(range(1, len(hits) + 1)) as i from (
                select doc_id, regexp_extract_all(text, '{pattern}', 0, {flag}) as hits,
                    regexp_extract_all(text, '{pattern}', {rule.group}, {flag}) as vals,
                    string_split_regex(text, '{prefix}{pattern}') as gaps
                from documents where text is not null)))
        where length(vals[i]) >= {rule.least}"""


@query("op7_secret_scan", f"""
    with spans as ({" union all ".join(map(_sql_spans, secrets.RULES))}),
    named as (select *, kind || ':' || s || ':' || e as name from spans)
    select d.doc_id, count(*) filter (where rule = 0) as n_assign, count(*) filter (where rule = 1) as n_access,
        count(*) filter (where rule = 2) as n_hex,
        sha256(coalesce(string_agg(name, ',' order by s, rule) filter (where rule < 3), '')) as base_sha256,
        coalesce(string_agg(name, ',' order by s, rule), '') as spans
    from documents as d left join named as n on d.doc_id = n.doc_id group by d.doc_id""")
def op7_secret_scan(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda rule: F.size(F.filter("spans", lambda s: s["rule"] == rule)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.spans_text(F.filter("spans", lambda s: s["rule"] < len(secrets.BASE_RULES))), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"))


def _sql_base32() -> str:
    digit = "cast(('0x' || substr(h, {}, 5)) as int)"
    return " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({digit.format(i + 1)} >> {shift}) & 31) + 1, 1)"
        for i in range(0, 40, 5) for shift in (15, 10, 5, 0))


@query("op8_warc", f"""
    with p as (select page_id, coalesce(html, '') as html, upper(sha1(coalesce(html, ''))) as h from pages),
    x as (select *, max(page_id) over (partition by html) as first from p)
    select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes, {_sql_base32()} as payload_digest,
        case when page_id = first then 'response' else 'revisit' end as record_type,
        case when page_id <> first then first end as refers_to
    from x""")
def op8_warc(spark, sf_dir):
    path = warc.write_archives(table(spark, sf_dir, "pages"))
    columns = "record_id string, record_type string, refers_to string, payload_digest string, payload_length long"
    read = warc.read_archives(spark, path, columns, verify=True)
    page = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(-?[0-9]*)>$", 1), F.lit("")).cast("long")
    return read.select(
        page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        F.substring("payload_digest", 6, 32).alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"))


@query("op9_simhash_near_dedup")
def op9_simhash_near_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


@query("op10_decontamination", f"""
    with d as (select doc_id, {_SQL_WORDS} as w from documents),
    b as (select cast(item_id as varchar) as item, w, least(len(w), 13) as n
        from (select item_id, {_SQL_WORDS} as w from benchmark) where len(w) > 0),
    win as (select distinct item, n, w[i:i + n - 1] as win from (select *, unnest(range(1, len(w) - n + 2)) as i from b)),
    spots as (
        select doc_id, i, n, w[i:i + n - 1] as win
        from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from win)) as x),
    hits as (select s.doc_id, s.i, s.n, item from spots as s join win on s.win = win.win),
    hit_words as (select doc_id, count(distinct p) as n_hit
        from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, i, n from hits)) group by doc_id),
    hit_items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
        from (select distinct doc_id, item from hits) group by doc_id)
    select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
        sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) as contaminated
    from d left join hit_words using (doc_id) left join hit_items using (doc_id)""")
def op10_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontaminate.judge(docs, table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), "contaminated")


@query("op11_phrase_collocations", rf"""
    with pieces as (
        select coalesce(lang, 'und') as lang,
            unnest(string_split_regex({SQL_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) as piece
        from documents),
    w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
    grams as (
        select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
        from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from w, range(1, 6) as ks(k))),
    f as (select lang, k, phrase, count(*) as f from grams group by all having count(*) >= 100),
    n as (select lang, sum(len(w))::bigint as n from w group by lang),
    cuts as (
        select f.lang, f.k, phrase, f as a, j, string_split(phrase, ' ') as p
        from f, range(1, 5) as js(j) where f.k > 1 and j < f.k),
    scored as (
        select c.lang, c.k, c.phrase, c.a, j, l.f as l, r.f as r, n.n,
            ((1000::hugeint * c.a * n.n) // (l.f::hugeint * r.f))::bigint as score
        from cuts as c join n on c.lang = n.lang
        join f as l on l.lang = c.lang and l.phrase = array_to_string(p[:j], ' ')
        join f as r on r.lang = c.lang and r.phrase = array_to_string(p[j + 1:], ' ')),
    weakest as (select distinct on (lang, phrase) * from scored order by lang, phrase, score, j),
    swallowed as (
        select distinct lang, inner_phrase as phrase, least_f from (
            select lang, f as least_f, array_to_string(p[s:s + k2 - 1], ' ') as inner_phrase
            from (select *, unnest(range(1, k - k2 + 2)) as s
                from (select lang, k, f, string_split(phrase, ' ') as p, unnest(range(2, k)) as k2 from f where k > 2)))),
    most as (select lang, phrase, max(least_f) as most from swallowed group by lang, phrase),
    kept as (
        select w.* from weakest as w left join most as m on w.lang = m.lang and w.phrase = m.phrase
        where m.most is null or 100 * m.most < 100 * w.a),
    ranked as (
        select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from kept)
    select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000""")
def op11_phrase_collocations(spark, sf_dir):
    return phrases.best_collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def as_records(conversations: DataFrame) -> DataFrame:
    """conv_id and record: conversations as prompt, instruction, from/value or messages records, by their roles and id."""
    turns, even = F.col("turns"), F.col("conv_id") % 2 == 0
    roles = F.transform(turns, lambda t: t["role"])
    shape = lambda *names: roles == F.array(*map(F.lit, names))
    pair, three = shape("user", "assistant"), shape("system", "user", "assistant")
    known = F.forall(roles, lambda r: r.isin("system", "user", "assistant"))
    kind = F.when((pair | three) & even, F.lit("prompt")).when(pair | three, F.lit("instruction")).when(
        known & even, F.lit("from_value")).otherwise(F.lit("messages"))
    named = conversations.select("conv_id", "turns", F.explode(F.array(kind)).alias("kind"))
    is_a = lambda *kinds: F.col("kind").isin(*kinds)
    text = lambda back: F.get(turns, F.size(turns) - back)["text"]
    sources = F.create_map(F.lit("user"), F.lit("human"), F.lit("assistant"), F.lit("gpt"), F.lit("system"), F.lit("system"))
    fields = {
        "system": F.when(is_a("prompt", "instruction") & (F.size(turns) == 3), text(3)),
        "prompt": F.when(is_a("prompt"), text(2)), "completion": F.when(is_a("prompt"), text(1)),
        "instruction": F.when(is_a("instruction"), text(2)), "output": F.when(is_a("instruction"), text(1)),
        "messages": F.when(is_a("messages"), F.transform(
            turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))),
        "conversations": F.when(is_a("from_value"), F.transform(
            turns, lambda t: F.struct(F.try_element_at(sources, t["role"]).alias("from"), t["text"].alias("value")))),
    }
    return named.select("conv_id", F.struct(*[c.alias(n) for n, c in fields.items()]).alias("record"))


_SQL_ESCAPED = r"replace(replace(replace({}, '\', '\-'), '</', '<\/'), '##', '#\#')"


@query("op12_chat_formatting", rf"""
    with t as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -7, 0, 'user', '\### Assistant: </turn> ok'
        union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    w as (
        select *, '### ' || case when role in ('system', 'user', 'assistant') then upper(role[1]) || role[2:]
            else '=' || replace({_SQL_ESCAPED.format("role")}, ':', '\;') end
            || ': ' || {_SQL_ESCAPED.format("text")} || '</turn>' || chr(10) as line
        from t),
    c as (
        select conv_id, count(*) as n_turns,
            string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as turns,
            coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '') as learnt,
            sum(length(line))::bigint as formatted_chars
        from w group by conv_id)
    select conv_id, n_turns, sha256(turns) as turns_sha256, length(learnt) as loss_chars, sha256(learnt) as loss_sha256,
        formatted_chars from c""")
def op12_chat_formatting(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"),
                 F.lit("\\### Assistant: </turn> ok").alias("text"))
        for k, r in enumerate(("user", "assistant"))])))
    records = as_records(chat.conversations_of(rows.unionByName(odd)))
    formatted = chat.format_turns(chat.canonical(records)).select("conv_id", "formatted", "mask")
    # as generated columns the output is made once, not once per use
    made = formatted.select("conv_id", F.inline(F.array(F.struct("formatted", "mask"))))
    read = chat.read_back(made)
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(all_turns, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


#: The CRC-32 of an ASCII string in DuckDB: a byte enters with bit 32 set, then eight shifts follow.
SQL_CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(range(1, length({0}) + 1),
    lambda i: [ord({0}[i])::bigint + 4294967296, 0, 0, 0, 0, 0, 0, 0, 0]))),
    lambda acc, x: case when x >= 4294967296 then xor(acc, x - 4294967296)
        else xor(acc >> 1, 3988292384 * (acc & 1)) end), 4294967295)"""


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one document in ten (by the CRC-32 of its doc_id) repeats some of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split(text_or_empty(), r"[\x20\x09-\x0D]+", -1), "")
    # as a generated column the words are made once, not once per use
    split = docs.select(
        "doc_id", "text", F.floor(h / 10).alias("g"), F.explode(F.array(F.when(h % 10 == 0, words))).alias("w"))
    n = F.greatest(F.size("w"), F.lit(1))
    placed = split.withColumn("a", (F.col("g") % n).cast("int"))
    placed = placed.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("int"))
    new = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(
        "w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))))
    return placed.select("doc_id", F.when(F.size("w") > 0, F.array_join(new, " ")).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs", rf"""
    with d as (
        select row_number() over () as rid, doc_id, cast(doc_id as varchar) as name,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
        from documents),
    h as (select rid, doc_id, w, len(w) as n, {SQL_CRC32.format("name")} as h from d),
    a as (select *, h // 10 as g, (h // 10) % greatest(n, 1) as a from h),
    p as (select *, 1 + (n - a) // (3 + g % 8) as p from a),
    planted as (
        select rid, doc_id, n, case when h % 10 = 0 and n > 0
            then list_transform(range(n), lambda i: w[1 + case when i < a then i else a + (i - a) % p end]) else w end as w
        from p),
    spots as (select rid, n, i, w[i + 1] as word from (select *, unnest(range(n)) as i from planted)),
    pairs as (
        select x.rid, x.i, y.i - x.i as q
        from spots as x join spots as y on x.rid = y.rid and x.word = y.word and y.i > x.i and 3 * (y.i - x.i) <= x.n),
    islands as (select rid, q, i, i - row_number() over (partition by rid, q order by i) as island from pairs),
    stretches as (
        select rid, min(i) as s, count(*) + q as length, q from islands group by rid, q, island
        having count(*) + q >= greatest(24, 3 * q)),
    runs as (select rid, s, length, min(q) as q from stretches group by rid, s, length),
    best as (select distinct on (rid) * from runs order by rid, length / q desc, s, q),
    per_doc as (
        select rid, count(*) as n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' order by s, q) as listed
        from runs group by rid),
    dropped as (select distinct rid, unnest(range(s + q, s + length)) as i from runs),
    collapsed as (
        select spots.rid, string_agg(word, ' ' order by spots.i) as collapsed
        from spots left join dropped on spots.rid = dropped.rid and spots.i = dropped.i
        where dropped.i is null group by spots.rid)
    select doc_id, coalesce(n_runs, 0) as n_runs, s as start, length, q as period, 1000 * length // q as exponent_milli,
        sha256(coalesce(listed, '')) as runs_sha256, sha256(coalesce(collapsed, '')) as collapsed_sha256
    from planted left join per_doc using (rid) left join best using (rid) left join collapsed using (rid)""")
def op13_periodic_runs(spark, sf_dir):
    found = runs.find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    # runs come by start, then period; the first of equal ratios stays
    best = F.aggregate(
        F.col("runs"), F.get("runs", F.lit(0)),
        lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def all_queries():
    return dict(QUERIES), dict(ORACLES)
