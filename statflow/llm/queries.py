"""The registered queries of this package, each over its whole table, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.llm import (
    decontaminate,
    divergence,
    grammar,
    html_text,
    language_id,
    licenses,
    manifest,
    near_duplicates,
    neighbours,
    packing,
    private_data,
    secrets,
    url_filter,
)
from statflow.llm.common import scratch_path, table
from statflow.llm.words import fold

TOKENIZER = "byte_bpe_50k.json"

#: (host, path, verdict) of the rules that ``op10_url_filter`` applies.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_duplicates.classes(table(spark, folder, "documents").select("doc_id", "text"))


def op2_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html_text.extract(pages)


def op3_private_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    found = private_data.annotate(table(spark, folder, "documents").select("doc_id", "text"))
    counts = [f"n_{kind}" for kind in private_data.BASE]
    return found.withColumns(private_data.digests(found)).select("doc_id", *counts, "base_sha256", "spans")


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.scan(docs, table(spark, folder, "benchmark")).drop("text", "hits")


OP4_SQL = """
with words as (
  select doc_id, row_number() over () as row,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
), item_words as (
  select item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark where item_id is not null
), windows as (
  select distinct item_id, size, array_to_string(w[i : i + size - 1], ' ') as win
  from (select item_id, w, least(10, len(w)) as size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i
        from item_words where len(w) > 0)
), grams as (
  select row, i, size, array_to_string(w[i : i + size - 1], ' ') as win
  from (select row, w, size, unnest(range(1, len(w) - size + 2)) as i
        from words, (select distinct size from windows) where len(w) >= size)
), found as (
  select row, i, size, item_id from grams join windows using (size, win)
), hits as (
  select row, count(*) as n_hit from (select distinct row, unnest(range(i, i + size)) from found) group by row
), items as (
  select row, count(*) as n_items, string_agg(item, ',' order by item) as list
  from (select distinct row, cast(item_id as varchar) as item from found) group by row
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hits using (row) left join items using (row)
"""


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document, learned from those that are not held out."""
    docs = table(spark, folder, "documents")
    model = language_id.learn(docs.where(~language_id.held_out()))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op6_pack(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents, written in grammar files and read back."""
    docs, path = table(spark, folder, "documents"), scratch_path(spark, "grammar")
    grammar.write(docs, path, public_tokenizers.path(TOKENIZER))
    return grammar.read(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest found for every twentieth vector."""
    rows = table(spark, folder, "embeddings")
    return neighbours.search(rows, rows.where("vec_id % 20 = 0"), "vec_id", "embedding")


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document."""
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[value.alias(name) for name, value in secrets.digests().items()])


def _op9_sql() -> str:
    """All matches of each rule, placed by the lengths of the pieces between them."""
    parts = []
    for at, rule in enumerate((*secrets.BASE, *secrets.MORE)):
        pattern = rule.pattern.replace("'", "''")
        value = f"regexp_extract(found, '{rule.value.replace("'", "''")}', 1)" if rule.value else "found"
        parts.append(f"""
  select row, {at} as place, '{rule.kind}' as kind, passed + gaps as "start", passed + gaps + len(found) as "end" from (
    select row, found, i,
      list_sum([len(x) for x in gap[1:i]]) as gaps,
      coalesce(list_sum([len(x) for x in hit[1:i - 1]]), 0) as passed
    from (select row, hit, gap, unnest(hit) as found, unnest(range(1, len(hit) + 1)) as i
          from (select row, regexp_extract_all(text, '{pattern}') as hit, regexp_split_to_array(text, '{pattern}') as gap from docs)
          where len(hit) > 0)
  ) where len({value}) >= {rule.least}""")
    listed = """string_agg(kind || ':' || cast("start" as bigint) || ':' || cast("end" as bigint), ',' order by "start", place)"""
    counts = ", ".join(f"count(*) filter (where kind = '{rule.kind}') as n_{rule.kind}" for rule in secrets.BASE)
    return f"""
with docs as (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
found as ({" union all ".join(parts)}),
summed as (
  select row, {counts}, {listed} filter (where place < {len(secrets.BASE)}) as base, {listed} as spans from found group by row
)
select doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0) as n_{rule.kind}" for rule in secrets.BASE)},
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join summed using (row)
"""


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the URL of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return url_filter.judge(pages, rules).drop("url")


OP10_SQL = """
with parsed as (
  select page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), rules(rule_host, rule_path, verdict) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits as (
  select page_id, host, path, rule_host || rule_path as rule, verdict,
    row_number() over (partition by page_id, host, path order by length(rule_host || rule_path) desc, length(rule_host) desc) as rank
  from parsed join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from parsed p left join (select * from fits where rank = 1) f using (page_id, host, path)
"""



def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document folded into the root of the manifest again, a third of them tampered with."""
    return manifest.audit(table(spark, folder, "documents"))


#: Levels that the SQL twin unrolls: 8 ** 8 documents of a language, 8 ** 3 languages.
OP11_LEVELS, OP11_TOP_LEVELS = 8, 3


def _op11_sql() -> str:
    """Node tables level by level; beside them each document's own digest and siblings so far."""
    field = lambda x: f"coalesce(strlen(cast({x} as varchar)) || ':' || cast({x} as varchar), '-')"
    fields = lambda text: " || ".join(field(x) for x in ("doc_id", "source", "lang", "n_chars", text))
    parts = [
        """crc_table as materialized (
  select list(code order by n) as codes from (
    select n, list_reduce(list_prepend(n, range(8)),
      lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) as code
    from (select unnest(range(256)) as n)))""",
        f"""docs as materialized (
  select row_number() over () as row, doc_id, coalesce('=' || lang, '') as g, sha256({fields("text")}) as leaf,
    sha256({fields("changed")}) as now
  from (
    select *, case when xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
          string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
        lambda c, b: xor(c >> 8, codes[(xor(c, b) & 255) + 1]))) % 3 = 0
      then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end as changed
    from documents, crc_table))""",
        """n0 as materialized (
  select row, g, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos, leaf as digest,
    count(*) over (partition by g) as size
  from docs)""",
        "f0 as materialized (select row, n0.g, pos, now as digest, '' as proof from n0 join docs using (row))",
    ]

    def level(node: str, fold: str, n: int) -> list[str]:
        return [
            f"""{node}{n} as materialized (
  select g, pos // 8 as pos, case when size > 1 then sha256(string_agg(digest, '' order by pos)) else any_value(digest) end as digest,
    (size + 7) // 8 as size
  from {node}{n - 1} group by g, pos // 8, size)""",
            f"""{fold}{n} as materialized (
  select f.row, f.g, f.pos // 8 as pos,
    case when n.size > 1 then sha256(string_agg(case when n.pos = f.pos then f.digest else n.digest end, '' order by n.pos))
      else f.digest end as digest,
    f.proof || coalesce(string_agg(n.digest, '' order by n.pos) filter (where n.pos <> f.pos), '') as proof
  from {fold}{n - 1} f join {node}{n - 1} n on n.g = f.g and n.pos // 8 = f.pos // 8
  group by f.row, f.g, f.pos, f.digest, f.proof, n.size)""",
        ]

    for n in range(1, OP11_LEVELS + 1):
        parts += level("n", "f", n)
    last = OP11_LEVELS
    parts += [
        f"""t0 as materialized (
  select '' as g, g as name, row_number() over (order by g) - 1 as pos, digest, count(*) over () as size from n{last})""",
        f"u0 as materialized (select f.row, t0.g, t0.pos, f.digest, f.proof from f{last} f join t0 on f.g = t0.name)",
    ]
    for n in range(1, OP11_TOP_LEVELS + 1):
        parts += level("t", "u", n)
    last = OP11_TOP_LEVELS
    return f"""
with {", ".join(parts)}
select doc_id, leaf, t0.digest as subroot, root.digest as root, sha256(u.proof) as proof_sha256, u.digest as folded_root,
  u.digest = root.digest as verified
from docs join u{last} u using (row) join t0 on docs.g = t0.name, t{last} as root
"""


def op12_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licenses that every document names or quotes."""
    found = licenses.scan(table(spark, folder, "documents").select("doc_id", "text"), keep=["doc_id"])
    joined = [F.array_join(name, ",").alias(name) for name in ("base_labels", "labels")]
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *joined, "score")


def _op12_sql() -> str:
    """All blocks of all texts against all notices of their width, and all places of the phrases."""
    quote = lambda words: "[" + ", ".join("'" + word.decode() + "'" for word in words) + "]"
    known = []
    for label, text in licenses.NOTICES:
        words = fold(text.encode()).split()
        own = sorted(set(words))
        known.append(f"('{label}', {quote(own)}, {licenses.width(len(words))}, {licenses.needed(len(own))})")
    phrases = [f"({quote(phrase.encode().split())}, '{label}')" for phrase, label in licenses.PHRASES]
    return f"""
with docs as materialized (
  select row_number() over () as row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
), notices(label, words, width, needed) as (values {", ".join(known)}
), phrases(words, label) as (values {", ".join(phrases)}
), blocks as (
  select row, width, list_distinct(w[i * (width // 2) + 1 : i * (width // 2) + width]) as own
  from (select row, w, width, unnest(range(len(w) // (width // 2) + 1)) as i from docs, (select distinct width from notices))
), met as (
  select row, label, len(list_intersect(words, own)) as common, len(words) as n, needed
  from notices join blocks using (width) where len(list_intersect(words, own)) >= needed
), places as (
  select row, label, i - 1 as place
  from (select row, w, p.words, label, unnest(range(1, len(w) - len(p.words) + 2)) as i from docs, phrases p)
  where w[i : i + len(words) - 1] = words
), base as (
  select row, count(*) as n_base, min(place) as first_word, max(place) as last_word,
    string_agg(distinct label, ',' order by label) as base_labels
  from places group by row
), every as (
  select row, string_agg(distinct label, ',' order by label) as labels, max(score) as score
  from (select row, label, 1.0::double as score from places union all select row, label, common / n from met) group by row
)
select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0::double) as score
from docs left join base using (row) left join every using (row)
"""


def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How far each source is from the others of its language, and its most distinctive terms."""
    return divergence.audit(table(spark, folder, "documents"))


OP13_SQL = """
with docs as materialized (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w
  from documents
), words as (select row, lang, source, unnest(w) as term from docs
), kept as materialized (
  select lang, term, count(*) as often from words group by lang, term having count(distinct row) >= 3
), groups as materialized (select distinct lang, source from docs
), had as materialized (
  select lang, source, term, count(*) as n from words semi join kept using (lang, term) group by all
), sizes as (
  select lang, count(*) as v, cast(sum(often) as bigint) as total from kept group by lang
), totals as (
  select g.lang, g.source, coalesce(cast(sum(n) as bigint), 0) as total from groups g left join had using (lang, source) group by all
), shares as materialized (
  select g.lang, g.source, k.term, coalesce(h.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(h.n, 0) + 1)) // (t.total + s.v) as p,
    1 + (1000000000::hugeint * (k.often + 1)) // (s.total + s.v) as q
  from groups g join kept k using (lang) join totals t using (lang, source) join sizes s using (lang)
    left join had h on h.lang = g.lang and h.source = g.source and h.term = k.term
), found as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(sum(((a.p - b.p) * (a.p - b.p)) // b.p) as bigint) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
  union all
  select a.lang, a.source, 'pair', b.source, 0 from groups a join groups b on a.lang = b.lang and a.source <> b.source
  where a.lang not in (select lang from kept)
  union all
  select lang, source, 'term', term, cast(((p - q) * (p - q)) // q as bigint) from shares where n > 0 and p > q
)
select lang, source, part, item, value,
  cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
from found qualify part = 'pair' or rank <= 200
"""

QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_main_text": op2_main_text,
    "op3_private_data": op3_private_data,
    "op4_decontaminate": op4_decontaminate,
    "op5_language": op5_language,
    "op6_pack": op6_pack,
    "op7_token_files": op7_token_files,
    "op8_neighbours": op8_neighbours,
    "op9_secrets": op9_secrets,
    "op10_url_filter": op10_url_filter,
    "op11_manifest": op11_manifest,
    "op12_licenses": op12_licenses,
    "op13_divergence": op13_divergence,
}
ORACLES = {"op4_decontaminate": OP4_SQL, "op9_secrets": _op9_sql(), "op10_url_filter": OP10_SQL, "op11_manifest": _op11_sql(), "op12_licenses": _op12_sql(), "op13_divergence": OP13_SQL}
