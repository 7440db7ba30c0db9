"""The registered queries of the corpus operators and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from staypath.llm.decontaminate import contaminated
from staypath.llm.frames import read
from staypath.llm.imatch import fingerprints
from staypath.llm.jaccard import near_copies
from staypath.llm.lines import line_digests
from staypath.llm.main_text import main_texts
from staypath.llm.phrases import collocations
from staypath.llm.pieces import round_trips
from staypath.llm.runs import run_digests
from staypath.llm.substrings import remove_repeats
from staypath.llm.suffix_tree import text_scores
from staypath.llm.toxicity import toxicity
from staypath.llm.urls import labelled_urls, url_verdicts
from staypath.llm.warc import read_records, write_archives


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(read(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(read(spark, sf_dir, "documents"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return url_verdicts(pages, labelled_urls(pages, read(spark, sf_dir, "labels")))


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(read(spark, sf_dir, "pages"))
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_latent_semantic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_scores(read(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(read(spark, sf_dir, "documents"))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read(spark, sf_dir, "pages"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(read(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


OP3_SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), keyed as (
  select *, regexp_replace(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), '', '') as bare from lines
), folded as (
  select *, translate(bare, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from keyed
), hot as (
  select key from folded where length(key) >= 1 group by key having count(distinct doc_id) >= 10
), marked as (
  select f.doc_id, f.pos, f.line, h.key is not null as dropped from folded f left join hot h on f.key = h.key
)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id
"""


OP7_SQL = """
with p as (
  select page_id, encode(coalesce(html, '')) as payload from pages
), d as (
  select page_id, octet_length(payload) as n, sha1(payload) as digest from p
), lead as (
  select digest, max(page_id) as leader from d where n >= 1000 group by digest
)
select page_id, n as payload_bytes, d.digest as payload_digest,
       case when leader <> page_id then 'revisit' else 'response' end as record_type,
       case when leader <> page_id then leader end as refers_to
from d left join lead on d.digest = lead.digest
"""


OP13_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), lists as (
  select lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') as ws from pieces
), totals as (
  select lang, sum(len(ws))::bigint as n from lists group by lang
), grams as (
  select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(list_slice(ws, i, i + k - 1), ' '))) as phrase
  from lists, range(1, 5) as sizes(k) where len(ws) >= k
), counted as (
  select lang, k, phrase, count(*) as f from grams group by lang, k, phrase
), candidates as (
  select lang, k as size, phrase, string_split(phrase, ' ') as ws, f as a from counted where k >= 2 and f >= 30
), cuts as (
  select c.lang, c.phrase, c.size, c.a, k, array_to_string(list_slice(ws, 1, k), ' ') as head, array_to_string(list_slice(ws, k + 1, c.size), ' ') as tail
  from candidates c, range(1, 4) as cut(k) where k < c.size
), scored as (
  select c.lang, c.phrase, c.size, c.a, c.k, l.f as l, r.f as r, ((2000000::hugeint * c.a) // (l.f + r.f))::bigint as score
  from cuts c join counted l on l.lang = c.lang and l.phrase = c.head join counted r on r.lang = c.lang and r.phrase = c.tail
), least as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), covers as (
  select lang, inner_phrase, max(a) as longer from (
    select lang, a, unnest(list_transform(range(1, size - m + 2), lambda i: array_to_string(list_slice(ws, i, i + m - 1), ' '))) as inner_phrase
    from candidates, range(2, 4) as lengths(m) where m < size
  ) group by lang, inner_phrase
), ranked as (
  select s.*, row_number() over (partition by s.lang order by score desc, a desc, s.phrase) as rank
  from least s left join covers c on c.lang = s.lang and c.inner_phrase = s.phrase
  where c.longer is null or 100::hugeint * c.longer < 80::hugeint * s.a
)
select r.lang, rank, phrase, a, l, r.r, n, score from ranked r join totals t on t.lang = r.lang where rank <= 2000
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_ngram_jaccard": op2_ngram_jaccard,
        "op3_line_dedup": op3_line_dedup,
        "op4_url_rules": op4_url_rules,
        "op5_suffix_array": op5_suffix_array,
        "op6_imatch": op6_imatch,
        "op7_warc": op7_warc,
        "op8_latent_semantic": op8_latent_semantic,
        "op9_suffix_tree": op9_suffix_tree,
        "op10_sentencepiece": op10_sentencepiece,
        "op11_main_text": op11_main_text,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_collocations": op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": OP3_SQL, "op7_warc": OP7_SQL, "op13_collocations": OP13_SQL}
