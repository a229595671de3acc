"""Every operator over its whole table, with the settings meant for production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthspan.llm import byte_pairs, conversations, fingerprints, html_text, language, licenses
from monthspan.llm import near_vectors, ngram_join, packing, periodic_runs, pieces, pii, quality


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(of: int) -> Column:
    """crc32(doc_id as text) mod ``of``; null without a doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """The classifier as learned from the labelled documents that are not held out."""
    return quality.learn(docs, _table(spark, sf_dir, "labels"), remainder(3) != 1)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents that share four fifths of their word 5-grams, and links per document."""
    return ngram_join.join(_table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by the merge-type vocabulary, decoded again."""
    return pieces.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors linked by a cosine of 0.9 or more."""
    return near_vectors.link(_table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every text, learned from two thirds of the labelled documents."""
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(spark, docs, sf_dir))
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from four fifths of the documents."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    model = language.learn(docs, ~held_out)
    found = language.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every text."""
    docs = _table(spark, sf_dir, "documents")
    return pii.find(docs, pii.learn(docs))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every text."""
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text."""
    return fingerprints.against_edits(_table(spark, sf_dir, "documents"))


def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by the byte-level vocabulary, decoded again."""
    docs = _table(spark, sf_dir, "documents")
    return byte_pairs.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults: by a checksum of its place, a row is lost, loses its text or the ends of its
    sentences, comes twice or is given to the user."""
    place = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    text = F.coalesce("text", F.lit(" "))
    rows = rows.withColumn("fault", F.crc32(place.cast("binary")) % 20).filter("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(F.col("fault") == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repairs of all conversations after damage; those that lost all rows need none."""
    rows = _table(spark, sf_dir, "conversations")
    repairs = conversations.repair(damaged(rows))
    every = rows.select(F.col("conv_id").alias("id")).distinct()
    found = every.join(repairs, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def made_periodic(docs: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the documents, by the id's checksum, words from some place on repeat with a
    period. A document without an id stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = h % 10 == 0
    words = F.when(chosen, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    docs = docs.select("doc_id", "text", (h / 10).cast("long").alias("g"), words.alias("words"))
    docs = docs.select("*", F.size("words").cast("long").alias("n"))
    docs = docs.select("*", F.when(F.col("n") > 0, F.col("g") % F.col("n")).alias("a"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    docs = docs.select("*", period.cast("int").alias("p"), (F.col("n") - F.col("a")).cast("int").alias("rest"))
    first = F.slice("words", F.lit(1), F.col("a").cast("int"))
    repeated = F.slice("words", F.col("a").cast("int") + 1, F.col("p"))
    times = F.ceil(F.col("rest") / F.col("p")).cast("int")
    rest = F.slice(F.flatten(F.array_repeat(repeated, times)), F.lit(1), F.col("rest"))
    text = F.when(F.col("n") > 0, F.array_join(F.concat(first, rest), " ")).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every text, a tenth of the texts made periodic, and the texts without repeats."""
    found = periodic_runs.find(made_periodic(_table(spark, sf_dir, "documents")))
    more = lambda x, y: x["length"] * y["period"] - y["length"] * x["period"]
    by_exponent = F.array_sort(
        "runs",
        lambda x, y: F.when(more(x, y) != 0, -F.signum(more(x, y)).cast("int"))
        .when(x["start"] != y["start"], F.signum(x["start"] - y["start"]).cast("int"))
        .otherwise(F.signum(x["period"] - y["period"]).cast("int")),
    )
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    found = found.select("*", F.get(by_exponent, F.lit(0)).alias("best"), lines.alias("lines"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_ngram_join,
        op2_html_text,
        op3_pieces,
        op4_near_vectors,
        op5_quality,
        op6_language,
        op7_pii,
        op8_packing,
        op9_licenses,
        op10_fingerprints,
        op11_byte_pairs,
        op12_conversations,
        op13_periodic_runs,
    )
}

_REACHED = """
    reach(id, r) as (
        select id, id from nodes union select reach.id, links.b from reach join links on links.a = reach.r),
    component as (select id, min(r) as least from reach group by id)"""

# The n-gram sets of all texts, joined on equal n-grams. Fewer than five words are one n-gram.
_NGRAM_JOIN = f"""
with recursive words as (
        select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\s]+') as w from documents),
    grams as (
        select doc_id as id, case when len(w) < 5 then [concat('<', array_to_string(w, ' '), '>')]
            else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) end as g
        from words),
    nodes as (select id, len(g) as n from grams),
    flat as (select id, unnest(g) as gram from grams),
    common as (
        select x.id as a, y.id as b, count(*) as n from flat x join flat y using (gram)
        where x.id <> y.id group by all),
    links as (
        select a, b from common join nodes p on p.id = a join nodes q on q.id = b
        where common.n / (p.n + q.n - common.n) >= {ngram_join.THRESHOLD}),
    {_REACHED}
select component.id as doc_id, least as class_id, count(links.b) as n_links
from component left join links on links.a = component.id group by all"""

_NEAR_VECTORS = f"""
with recursive nodes as (select vec_id as id, embedding::double[] as v from embeddings),
    links as (
        select x.id as a, y.id as b from nodes x join nodes y on x.id <> y.id
        where list_cosine_similarity(x.v, y.v) >= {near_vectors.THRESHOLD}),
    {_REACHED}
select component.id as vec_id, count(links.b) as n_links, least as component_id, component.id = least as kept
from component left join links on links.a = component.id group by all"""

_TEMPLATES = ", ".join(f"('{name}', '{text}')" for name, text in licenses.TEMPLATES.items())
_SHINGLES = """case when len(w) < 5 then [] else
    list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) end"""
_WORDS = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"

_LICENSES = f"""
with templates(license, text) as (values {_TEMPLATES}),
    wanted as (select license, {_SHINGLES} as g from (select license, {_WORDS} as w from templates)),
    held as (select doc_id, {_SHINGLES} as g from (select doc_id, {_WORDS} as w from documents)),
    parts as (
        select doc_id, license, len(list_intersect(wanted.g, held.g)) / len(wanted.g) as part
        from held, wanted),
    verified as (select * from parts where part >= {licenses.CONTAINMENT})
select held.doc_id, count(license) as n_licenses,
    coalesce(string_agg(license, ',' order by license), '') as licenses,
    coalesce(max(part), 0)::double as containment
from held left join verified using (doc_id) group by all"""

# A conversation's rows one after the other, with the cheapest edits for each of four states: nothing, system,
# user, pair. Lines begin with their line break, so the first character of the whole is cut off.
_CONVERSATIONS = """
with recursive crc as (
        select list_transform(range(256), lambda i: list_reduce(range(8),
            lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end, i)) as t),
    placed as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::text, ' ') as conv,
            concat(coalesce(conv_id::text, ' '), ':', coalesce(turn::text, ' ')) as place from conversations),
    hit as (
        select placed.*, xor(4294967295, list_reduce(list_transform(range(1, strlen(place) + 1), lambda k: ord(place[k])),
            lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295)) % 20 as fault from placed, crc),
    damaged as (
        select conv, turn, case when fault = 4 then 'user' else role end as role,
            case when fault = 1 then '' when fault = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
            unnest(range(case when fault = 3 then 2 else 1 end)) as copy
        from hit where fault <> 0),
    numbered as (
        select *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as content,
            row_number() over (partition by conv order by turn nulls first, role, text, copy) as i from damaged),
    faults as (
        select conv, i, turn, role, text, left(role, 1) as initial, case when content = '' then 'blank'
            when row_number() over (partition by conv, role, text order by i) > 1 then 'duplicate'
            when right(content, 1) not in ('.', '!', '?') then 'truncated' end as fault
        from numbered),
    inserts(state, after, letters, price, lines) as (values
        (0, 0, '', 0, ''), (0, 2, 'I', 2, chr(10) || 'user:'), (0, 3, 'II', 4, chr(10) || 'user:' || chr(10) || 'assistant:'),
        (1, 1, '', 0, ''), (1, 2, 'I', 2, chr(10) || 'user:'), (1, 3, 'II', 4, chr(10) || 'user:' || chr(10) || 'assistant:'),
        (2, 2, '', 0, ''), (2, 3, 'I', 2, chr(10) || 'assistant:'), (3, 3, '', 0, ''), (3, 2, 'I', 2, chr(10) || 'user:')),
    edits(state, initial, letter, after, price, role) as (values
        (0, null, 'D', 0, 3, null), (1, null, 'D', 1, 3, null), (2, null, 'D', 2, 3, null), (3, null, 'D', 3, 3, null),
        (0, 's', 'K', 1, 0, null), (0, 'u', 'K', 2, 0, null), (1, 'u', 'K', 2, 0, null), (2, 'a', 'K', 3, 0, null),
        (3, 'u', 'K', 2, 0, null), (0, null, 'R', 2, 2, 'user'), (1, null, 'R', 2, 2, 'user'),
        (2, null, 'R', 3, 2, 'assistant'), (3, null, 'R', 2, 2, 'user')),
    best as (
        select distinct conv, 0::bigint as i, 0 as state, 0::bigint as cost, '' as audit, '' as lines from placed
        union all
        select conv, i, state, least.cost, least.audit, least.lines from (
            select f.conv, f.i, e.after as state, min({
                'cost': b.cost + n.price + e.price + case when e.letter <> 'D' and f.fault = 'truncated' then 1 else 0 end,
                'audit': concat(b.audit, n.letters, e.letter),
                'lines': concat(b.lines, n.lines, case when e.letter <> 'D'
                    then concat(chr(10), coalesce(e.role, f.role), ':', f.text) end)}) as least
            from best b join faults f on f.conv = b.conv and f.i = b.i + 1
            join inserts n on n.state = b.state join edits e on e.state = n.after
                and (e.initial is null or e.initial = f.initial)
                and (e.letter = 'D' or coalesce(f.fault, '') not in ('blank', 'duplicate'))
            group by all)),
    ends as (
        select conv, min({'cost': b.cost + n.price, 'audit': b.audit || n.letters, 'lines': b.lines || n.lines}) as least
        from best b join inserts n on n.state = b.state
        where n.after in (0, 3) and b.i = (select count(*) from faults f where f.conv = b.conv) group by all),
    pairs as (
        select *, lag(initial) over (partition by conv order by i) || initial as pair from faults),
    counts as (
        select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
            count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
            count(*) filter (fault = 'truncated') as truncated,
            count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
        from pairs group by all)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, least.cost as cost, least.audit as audit,
    sha256(substr(least.lines, 2)) as repaired_sha256
from (select distinct conv_id, conv from placed) o join ends using (conv) left join counts using (conv)"""

# The others are no matter of SQL; the tests hold them against plain versions, libraries and labels.
ORACLES: dict[str, str] = {
    "op1_ngram_join": _NGRAM_JOIN,
    "op4_near_vectors": _NEAR_VECTORS,
    "op9_licenses": _LICENSES,
    "op12_conversations": _CONVERSATIONS,
}
