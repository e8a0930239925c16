"""Queries over the driver's tables, each with the DuckDB SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffspark.functions import codes, text
from tariffspark.operators import audit, build, chat, dictionary, extraction, normalize, rulings, score, suffix
from tariffspark.session import scratch
from tariffspark.plans import prepare
from tariffspark.sources import files
from tariffspark.sources.keyed import KeyedTable
from tariffspark.streaming import queue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ITEMS = """select doc_id as seq, text as description, source, lang,
  concat('N', lpad(cast(cast(floor(doc_id / 2.0) as bigint) as varchar(20)), 6, '0')) as ruling_number,
  concat(lpad(cast(n_chars % 97 + 1 as varchar(20)), 2, '0'), lpad(cast(n_chars * 17 % 89 as varchar(20)), 2, '0'), '.',
         lpad(cast(n_chars % 7 * 10 as varchar(20)), 2, '0'), '.', lpad(cast(n_chars % 13 * 10 as varchar(20)), 4, '0')) as hts_code
from documents"""
_PREDS = """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, g as gold_code, k,
  case when l_linenumber % 3 = 0 then concat(substr(g, 1, 8), '99') end as gold_2,
  l_orderkey % 11 = 0 as gold_abstain, k <> 8 as parse_ok, k <> 9 as pred_present, k = 10 or (l_orderkey % 11 = 0 and k < 7) as pred_abstain,
  case when k not in (8, 9, 10) and not (l_orderkey % 11 = 0 and k < 7) then
    case k when 2 then concat(substr(g, 1, 8), '99') when 3 then concat(substr(g, 1, 6), '9900') when 4 then concat(substr(g, 1, 4), '990000')
           when 5 then concat(substr(g, 1, 2), '99000000') when 6 then concat('98', substr(g, 3)) when 7 then '99' else g end end as pred
from (select *, (l_orderkey + l_linenumber) % 12 as k,
    concat(lpad(cast(l_partkey % 97 + 1 as varchar(20)), 2, '0'), lpad(cast(l_partkey % 89 as varchar(20)), 2, '0'),
           lpad(cast(l_suppkey % 83 as varchar(20)), 2, '0'), lpad(cast(l_orderkey % 7 * 10 as varchar(20)), 4, '0')) as g
  from lineitem) b"""
PREDS = f"""select *, case when k = 11 then '73' else substr(pred, 1, 2) end as pred_chapter, case when k <> 1 then concat(substr(pred, 1, 2), '.', substr(pred, 3, 2)) end as pred_heading,
  case when k = 0 then concat(substr(pred, 1, 4), '.99') else concat(substr(pred, 1, 4), '.', substr(pred, 5, 2)) end as pred_subheading from ({_PREDS}) w"""
EXAMPLES = f"""select seq, description, source, lang, case when seq % 10 <> 9 then ruling_number end as ruling_number, hts_code, seq % 7 = 0 as abstain, case when seq % 7 = 0 then 'abstention' else 'hierarchical_classify' end as task_type,
  case seq % 4 when 0 then 'rich' when 1 then 'minimal' when 2 then 'glossary_enriched' else 'materials_only' end as input_variant,
  case when seq % 7 = 0 then case seq % 3 when 0 then 'vague_description' when 1 then 'missing_materials' else 'ambiguous_use' end end as abstain_category from ({ITEMS}) w"""
_N = "replace(hts_code, '.', '')"
FLAGS = f"""with preds as ({PREDS}), v as (select *, parse_ok and pred_present and not pred_abstain and not gold_abstain and coalesce(regexp_matches(pred, '^[0-9]{{4,10}}$'), false) as valid,
  rpad(coalesce(pred, ''), 10, '0') as p from preds),
flags as (select *, """ + ", ".join(f"valid and (substr(p,1,{n}) = substr(gold_code,1,{n}) or coalesce(substr(p,1,{n}) = substr(gold_2,1,{n}), false)) as hit_{k}" for k, n in codes.LEVELS.items()) + """,
  valid and ltrim(pred_chapter, '0') = ltrim(substr(p,1,2), '0') and (pred_heading is null or replace(pred_heading, '.', '') = substr(p,1,4)) and replace(pred_subheading, '.', '') = substr(p,1,6) as consistent from v)"""  # fmt: skip


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as labelled product descriptions."""
    d, n = _table(spark, sf_dir, "documents"), F.col("n_chars")
    part = lambda c, w: F.lpad(c.cast("string"), w, "0")
    code = F.concat(part(n % 97 + 1, 2), part(n * 17 % 89, 2), F.lit("."), part(n % 7 * 10, 2), F.lit("."), part(n % 13 * 10, 4))
    return d.select(F.col("doc_id").alias("seq"), F.col("text").alias("description"), "source", "lang", F.concat(F.lit("N"), part(F.floor(F.col("doc_id") / 2), 6)).alias("ruling_number"), code.alias("hts_code"))


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as predictions with every kind of error."""
    part = lambda c, w: F.lpad(c.cast("string"), w, "0")
    li = _table(spark, sf_dir, "lineitem").withColumn("k", (F.col("l_orderkey") + F.col("l_linenumber")) % 12)
    g = F.concat(part(F.col("l_partkey") % 97 + 1, 2), part(F.col("l_partkey") % 89, 2), part(F.col("l_suppkey") % 83, 2), part(F.col("l_orderkey") % 7 * 10, 4))
    li = li.withColumn("gold_code", g).withColumn("gold_abstain", F.col("l_orderkey") % 11 == 0)
    li = li.withColumn("pred_abstain", (F.col("k") == 10) | (F.col("gold_abstain") & (F.col("k") < 7)))
    cut = lambda n, tail: F.concat(F.substring("gold_code", 1, n), F.lit(tail))
    k = F.col("k")
    code = F.when(k == 2, cut(8, "99")).when(k == 3, cut(6, "9900")).when(k == 4, cut(4, "990000")).when(k == 5, cut(2, "99000000")).when(k == 6, F.concat(F.lit("98"), F.substring("gold_code", 3, 8))).when(k == 7, F.lit("99")).otherwise(F.col("gold_code"))
    second = F.when(F.col("l_linenumber") % 3 == 0, cut(8, "99"))
    known = li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "gold_code", "k", second.alias("gold_2"), F.array_compact(F.array("gold_code", second)).alias("gold"), "gold_abstain",
        (k != 8).alias("parse_ok"), (k != 9).alias("pred_present"), "pred_abstain", F.when(~k.isin(8, 9, 10) & ~F.col("pred_abstain"), code).alias("pred"),
    )
    at = lambda i, n: F.substring("pred", i, n)
    return known.withColumns({
        "pred_chapter": F.when(k == 11, "73").otherwise(at(1, 2)), "pred_heading": F.when(k != 1, F.concat(at(1, 2), F.lit("."), at(3, 2))),
        "pred_subheading": F.when(k == 0, F.concat(at(1, 4), F.lit(".99"))).otherwise(F.concat(at(1, 4), F.lit("."), at(5, 2))),
    })


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as training examples, with abstentions and rows that have no ruling."""
    q = F.col("seq")
    abstain = q % 7 == 0
    pick = lambda n, names: F.element_at(F.array(*map(F.lit, names)), (q % n + 1).cast("int"))
    return items(spark, sf_dir).withColumns({
        "ruling_number": F.when(q % 10 != 9, F.col("ruling_number")), "abstain": abstain, "task_type": F.when(abstain, "abstention").otherwise("hierarchical_classify"),
        "input_variant": pick(4, ("rich", "minimal", "glossary_enriched", "materials_only")), "abstain_category": F.when(abstain, pick(3, build.CATEGORIES)),
    })


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


_M = "count_if(hit_exact)/greatest(count_if(not gold_abstain),1) as exact_match, count_if(hit_chapter)/greatest(count_if(not gold_abstain),1) as chapter_match, count_if(hit_heading)/greatest(count_if(not gold_abstain),1) as heading_match, count_if(hit_subheading)/greatest(count_if(not gold_abstain),1) as subheading_match"


@query(f"{FLAGS} select count(*) as total, count_if(parse_ok)/count(*) as parse_rate, {_M}, count_if(gold_abstain and parse_ok and pred_abstain)/greatest(count_if(gold_abstain),1) as abstain_recall, count_if(gold_abstain) as abstain_count, count_if(consistent)/greatest(count_if(valid),1) as hierarchy_consistency from flags")
def eval_metrics(spark, sf_dir):
    return score.metrics(score.flagged(preds(spark, sf_dir)))


@query(f"with preds as ({PREDS}) select count(*) as total, count_if(parse_ok) as parse_ok, count_if(not parse_ok) as parse_fail from preds")
def parse_totals(spark, sf_dir):
    return score.parse_totals(preds(spark, sf_dir))


@query(f"{FLAGS} select substr(gold_code,1,2) as chapter, count(*) as total, {_M} from flags where not gold_abstain group by 1")
def eval_by_chapter(spark, sf_dir):
    return score.by_chapter(score.flagged(preds(spark, sf_dir)))


_BUCKET = "case when not parse_ok then 'parse_failure' when not pred_present then 'missing_prediction' when gold_abstain and not pred_abstain then 'missed_abstain' when not gold_abstain and pred_abstain then 'false_abstain' when gold_abstain then null when not valid then 'hallucinated_code' when hit_exact then null when not hit_chapter then 'wrong_chapter' when not hit_heading then 'right_chapter_wrong_heading' when not hit_subheading then 'right_heading_wrong_subheading' else 'right_subheading_wrong_full' end"


@query(f"{FLAGS} select {_BUCKET} as bucket, count(*) as n from flags group by 1 having bucket is not null")
def error_buckets(spark, sf_dir):
    return score.error_buckets(score.flagged(preds(spark, sf_dir)))


_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(f"{FLAGS} select bucket, rn, l_orderkey, l_linenumber, l_partkey, gold_code, pred, substr(repeat(gold_code, 30), 1, 200) as description from (select *, row_number() over (partition by bucket order by {', '.join(_ORDER)}) as rn from (select *, {_BUCKET} as bucket from flags) where bucket is not null) where rn <= 5")
def error_samples(spark, sf_dir):
    rows = preds(spark, sf_dir).withColumn("description", F.repeat("gold_code", 30))
    return score.error_samples(score.flagged(rows), _ORDER, ("description",)).select("bucket", "rn", "l_orderkey", "l_linenumber", "l_partkey", "gold_code", "pred", "description")


@query(f"{FLAGS} select l_orderkey, l_linenumber, gold_code, pred from flags where valid and not hit_exact")
def failures(spark, sf_dir):
    return score.failures(score.flagged(preds(spark, sf_dir))).select("l_orderkey", "l_linenumber", "gold_code", "pred")


@query(f"{FLAGS}, m as (select l_orderkey % 2 as run, cast(count(*) as double) as total, count_if(hit_exact)/greatest(count_if(not gold_abstain),1) as exact_match from flags group by 1), u as (unpivot m on total, exact_match into name metric value v) select o.metric, o.v as old_value, n.v as new_value, round(n.v - o.v, 4) as delta from u o join u n using (metric) where o.run = 0 and n.run = 1")
def metrics_delta(spark, sf_dir):
    flags = score.flagged(preds(spark, sf_dir))
    run = lambda k: score.metrics(flags.where(F.col("l_orderkey") % 2 == k)).select("total", "exact_match")
    return score.deltas(run(0), run(1))


_INDEX = f"idx as (select gold_code as code, count(*) as n from preds where not gold_abstain group by 1)"


@query(f"with preds as ({PREDS}), {_INDEX} select * from idx")
def suffix_index(spark, sf_dir):
    return suffix.index(preds(spark, sf_dir))


@query(f"with preds as ({PREDS}), {_INDEX} select substr(code,1,8) as prefix, string_agg(code, ',' order by n desc, code) as codes from idx group by 1")
def suffix_children(spark, sf_dir):
    return suffix.children(suffix.index(preds(spark, sf_dir))).withColumn("codes", F.array_join("codes", ","))


@query(f"with preds as ({PREDS}), {_INDEX}, s as (select substr(code,1,8) as prefix, count(*) as k from idx group by 1), r as (select k, row_number() over (order by k) as rn, count(*) over () as c from s) select (select count(*) from idx) as n_codes, count(*) as n_prefixes, max(k) as max_children, (select k from r where rn = c // 2 + 1) as median_children from s")
def suffix_meta(spark, sf_dir):
    return suffix.meta(suffix.index(preds(spark, sf_dir)))


@query(f"with preds as ({PREDS}), c as (select gold_abstain as a, case when k % 3 = 0 then substr(gold_code, 1, 6) else gold_code end as code from preds) select count_if(not a and length(code) >= 8) as indexed, count_if(a) as skipped_abstain, count_if(not a and length(code) < 8) as skipped_short from c")
def suffix_skipped(spark, sf_dir):
    cut = F.when(F.col("k") % 3 == 0, F.substring("gold_code", 1, 6)).otherwise(F.col("gold_code"))
    return suffix.skipped(preds(spark, sf_dir).withColumn("gold_code", cut))


_DONE = f"""with preds as ({PREDS}), {_INDEX}, best as (select substr(code,1,8) as prefix, first(code order by n desc, code) as best from idx group by 1),
done as (select p.*, case when pred_abstain then 'skipped_abstain' when pred is null then 'skipped_no_code' when i.code is not null then 'valid' when best is null then 'no_8digit_match' when best = rpad(pred,10,'0') then 'no_change_possible' else 'completed' end as reason, best
  from preds p left join idx i on i.code = rpad(p.pred,10,'0') left join best b on b.prefix = substr(rpad(p.pred,10,'0'),1,8))"""


@query(f"{_DONE} select l_orderkey, l_linenumber, l_partkey, reason, case when reason = 'completed' then substr(best,1,4)||'.'||substr(best,5,2)||'.'||substr(best,7,4) else pred end as pred_after from done")
def suffix_apply(spark, sf_dir):
    p = preds(spark, sf_dir)
    return suffix.complete(p, suffix.index(p), ("l_orderkey", "l_linenumber")).select("l_orderkey", "l_linenumber", "l_partkey", "reason", "pred_after")


@query(f"{_DONE} select reason, count(*) as n from done group by 1")
def suffix_reasons(spark, sf_dir):
    p = preds(spark, sf_dir)
    return suffix.reasons(suffix.complete(p, suffix.index(p), ("l_orderkey", "l_linenumber")))


@query(f"with items as ({ITEMS}) select seq, {_N} as normalized, hts_code as dotted, substr({_N},1,2) as chapter, substr({_N},1,4) as heading, substr({_N},1,6) as subheading from items")
def code_hierarchy(spark, sf_dir):
    c = F.col("hts_code")
    return items(spark, sf_dir).select("seq", codes.normalized(c).alias("normalized"), codes.dotted(c).alias("dotted"), *[codes.prefix(c, codes.LEVELS[k]).alias(k) for k in ("chapter", "heading", "subheading")])


_GIVEN = f"case seq % 5 when 0 then substr(hts_code,1,4) || '.' when 1 then substr(hts_code,1,2) when 2 then substr(hts_code,1,4) || 'AB' when 3 then {_N} || '77' else ' ' || hts_code || '-' end"
_FORM = f"case seq % 5 when 0 then rpad(substr(hts_code,1,4),10,'0') when 3 then {_N} || '77' when 4 then {_N} end"


@query(f"with items as ({ITEMS}), g as (select *, {_GIVEN} as given, {_FORM} as normalized from items) select seq, given, normalized, concat_ws('.', substr(normalized,1,4), substr(normalized,5,2), substr(normalized,7,4)) as dotted, seq % 5 in (0, 4) as ok, substr(regexp_replace(given, '[^0-9]', '', 'g'),1,8) as eight, substr(normalized,1,2) as chapter, substr(normalized,1,10) as exact, seq % 5 in (0, 1, 3) as agrees, seq % 6 = 5 as agrees_other from g")
def code_short_forms(spark, sf_dir):
    """CD1-CD5, CD7, CD11 on short, invalid, over-long and spaced codes, and on tariffs that disagree."""
    c, q = F.col("hts_code"), F.col("seq")
    bare = F.replace(c, F.lit("."), F.lit(""))
    given = F.when(q % 5 == 0, F.concat(F.substring(c, 1, 4), F.lit("."))).when(q % 5 == 1, F.substring(c, 1, 2)).when(q % 5 == 2, F.concat(F.substring(c, 1, 4), F.lit("AB"))).when(q % 5 == 3, F.concat(bare, F.lit("77"))).otherwise(F.concat(F.lit(" "), c, F.lit("-")))
    rows = items(spark, sf_dir).withColumn("given", given)
    g, levels = F.col("given"), codes.hierarchy(F.col("given"))
    other = F.array(F.lit("no code"), F.when(q % 6 == 5, c).otherwise(F.concat(F.lit("00"), c)))
    return rows.select("seq", "given", codes.normalized(g).alias("normalized"), codes.dotted(g).alias("dotted"), codes.is_valid(g).alias("ok"), codes.digit_prefix(g, 8).alias("eight"), levels["chapter"].alias("chapter"), levels["exact"].alias("exact"), codes.agrees_with_any(c, F.array(F.rtrim(g, F.lit("-")))).alias("agrees"), codes.agrees_with_any(c, other).alias("agrees_other"))


@query(f"with items as ({ITEMS}) select seq, case when seq % 4 = 0 then '1' else substr(hts_code,1,2) end as chapter_code, case when seq % 4 = 1 then '99.99' else substr(hts_code,1,2) || '.' || substr(hts_code,3,2) end as heading_code, substr(hts_code,1,4) || '.' || substr({_N},5,2) as subheading_code, not (seq % 4 = 0 and substr(hts_code,1,2) <> '01') and not (seq % 4 = 1 and substr(hts_code,1,4) <> '9999') as consistent from items")
def code_backfill(spark, sf_dir):
    """CD12-CD14: missing levels come from those below; given ones may contradict the code."""
    c, q = F.col("hts_code"), F.col("seq")
    heading = F.when(q % 4 == 1, codes.canonical_level(F.lit("9999"), 2, 4)).when(q % 4 == 2, codes.canonical_level(F.substring(c, 1, 4), 2, 4))
    sub = F.when(q % 4 == 3, codes.canonical_level(F.substring(codes.normalized(c), 1, 6), 4, 6)).otherwise("")
    filled = codes.backfilled(F.when(q % 4 == 0, "1"), heading, sub, c)
    # where the heading is given, the chapter is its own
    chapter = F.when(q % 4 == 1, F.substring(c, 1, 2)).otherwise(filled["chapter_code"])
    return items(spark, sf_dir).select("seq", chapter.alias("chapter_code"), filled["heading_code"].alias("heading_code"), filled["subheading_code"].alias("subheading_code"), codes.consistent(chapter, filled["heading_code"], filled["subheading_code"], c).alias("consistent"))


@query(f"with items as ({ITEMS}) select seq, {_N} as hts_code from items where length(description) between 30 and 2048")
def normalize_filter(spark, sf_dir):
    return normalize.length_band(normalize.valid_codes(items(spark, sf_dir))).select("seq", "hts_code")


@query(f"with items as ({ITEMS}) select min(seq) as seq from items group by trim(lower(description), ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)), hts_code")
def exact_dedup(spark, sf_dir):
    return normalize.exact_dedup(items(spark, sf_dir)).select("seq")


@query(f"with items as ({ITEMS}) select 'source' as kind, source as value, count(*) as n from items group by source union all select 'lang', lang, count(*) from items group by lang")
def audit_counts(spark, sf_dir):
    return audit.counts(items(spark, sf_dir), ["source", "lang"])


@query(f"with items as ({ITEMS}), r as (select length(description) as len, row_number() over (order by length(description)) as rn, count(*) over () as c from items) select count(*) as total, min(len) as min_len, max(len) as max_len, avg(len) as mean_len, max(case when rn = c // 2 + 1 then len end) as median_len from r")
def audit_lengths(spark, sf_dir):
    return audit.lengths(items(spark, sf_dir)).select("total", "min_len", "max_len", "mean_len", "median_len")


@query(f"with items as ({ITEMS}) select hts_code, count(*) as n from items group by 1 order by n desc, hts_code limit 20")
def audit_top_codes(spark, sf_dir):
    return audit.top_codes(items(spark, sf_dir))


@query(f"with items as ({ITEMS}), p as (select count(*) as n from items group by hts_code) select count_if(n=1) as codes_0, count_if(n between 2 and 5) as codes_1, count_if(n between 6 and 20) as codes_2, count_if(n between 21 and 50) as codes_3, count_if(n between 51 and 100) as codes_4, count_if(n>100) as codes_5 from p")
def audit_hist(spark, sf_dir):
    return audit.frequency_histogram(items(spark, sf_dir))


@query(f"with items as ({ITEMS}) select count(distinct substr({_N},1,2)) as n_chapter, count(distinct substr({_N},1,4)) as n_heading, count(distinct {_N}) as n_exact from items")
def audit_levels(spark, sf_dir):
    return audit.distinct_levels(items(spark, sf_dir))


@query(f"with items as ({ITEMS}), p as (select substr(hts_code,1,2) as c, count(*) as n from items group by 1) select max(n)/greatest(min(n),1) as imbalance from p")
def audit_imbalance(spark, sf_dir):
    return audit.imbalance(items(spark, sf_dir))


@query(f"with e as ({EXAMPLES}) select 'source' as kind, source as value, count(*) as n from e where source is not null group by 2 union all select 'chapter', case when abstain then '__abstain__' else substr(hts_code,1,2) end, count(*) from e group by 2 union all select 'task', task_type, count(*) from e group by 2 union all select 'variant', input_variant, count(*) from e where not abstain group by 2 union all select 'abstain_category', abstain_category, count(*) from e where abstain group by 2")
def audit_training(spark, sf_dir):
    return audit.training_counts(examples(spark, sf_dir))


@query(f"with e as ({EXAMPLES}) select count(*) as total, count_if(abstain) as n_abstain, count_if(abstain) / greatest(count(*), 1) as abstain_rate from e")
def audit_abstentions(spark, sf_dir):
    return audit.abstentions(examples(spark, sf_dir))


@query(f"with e as ({EXAMPLES}) select count_if(not abstain) as total, count_if(not abstain and coalesce(description,'')<>'') as with_description, count_if(not abstain and coalesce(ruling_number,'')<>'') as with_ruling_number, count_if(not abstain and seq % 3 > 0) as with_terms from e")
def audit_coverage(spark, sf_dir):
    terms = F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1), (F.col("seq") % 3).cast("int"))
    return audit.coverage(examples(spark, sf_dir).withColumn("terms", terms), ["description", "ruling_number"], ("terms",))


_DIMS = "chapters as (select distinct lpad(cast(p_size as varchar(20)),2,'0') as chapter, concat('size ', p_size) as chapter_description from part), headings as (select substr(hts_code,1,4) as hts4, min(source) as heading_description from items where seq % 3 = 0 group by 1), tariffs as (select concat(substr(hts_code,1,4), substr(hts_code,6,2), substr(hts_code,9,2)) as hts8, min(lang) as tariff_description from items where seq % 2 = 0 group by 1)"


def _dims(spark, sf_dir):
    i = items(spark, sf_dir)
    chapters = _table(spark, sf_dir, "part").select(F.lpad(F.col("p_size").cast("string"), 2, "0").alias("chapter"), F.concat(F.lit("size "), F.col("p_size")).alias("chapter_description")).distinct()
    headings = i.where("seq % 3 = 0").groupBy(F.substring("hts_code", 1, 4).alias("hts4")).agg(F.min("source").alias("heading_description"))
    tariffs = i.where("seq % 2 = 0").groupBy(codes.digit_prefix(F.col("hts_code"), 8).alias("hts8")).agg(F.min("lang").alias("tariff_description"))
    return i, chapters, headings, tariffs


@query(f"with items as ({ITEMS}), {_DIMS} select seq, chapter_description, heading_description, tariff_description from items left join chapters on chapter = substr(hts_code,1,2) left join headings on hts4 = substr(hts_code,1,4) left join tariffs on hts8 = substr({_N},1,8)")
def enrich_join(spark, sf_dir):
    return rulings.enriched(*_dims(spark, sf_dir)).select("seq", "chapter_description", "heading_description", "tariff_description")


@query(f"with items as ({ITEMS}), {_DIMS} select seq, substr({_N},1,8) as level_code, hts8 is not null as is_valid from items left join tariffs on hts8 = substr({_N},1,8)")
def current_valid(spark, sf_dir):
    i, _, _, tariffs = _dims(spark, sf_dir)
    return rulings.current_valid(i, tariffs).select("seq", "level_code", "is_valid")


@query(f"with items as ({ITEMS}), {_DIMS} select count(*) as total, count(hts8) as kept, count(*) - count(hts8) as excluded, 100 * count(hts8) / count(*) as pct_kept from items left join tariffs on hts8 = substr({_N},1,8)")
def export_stats(spark, sf_dir):
    i, _, _, tariffs = _dims(spark, sf_dir)
    return rulings.export_stats(rulings.current_valid(i, tariffs))


@query(f"with items as ({ITEMS}), {_DIMS} select 8 as digits, hts8 as code from tariffs union select 6, substr(hts8,1,6) from tariffs union select 4, substr(hts8,1,4) from tariffs")
def valid_code_sets(spark, sf_dir):
    return rulings.valid_sets(_dims(spark, sf_dir)[3])


def _done(spark, sf_dir):
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("ruling_number"), F.when(F.col("quality") == 0, rulings.FAILED).otherwise("done").alias("description"))
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("ruling_number"), "source"), labels


@query("select cast(doc_id as varchar) as ruling_number, source from documents where doc_id not in (select doc_id from labels)")
def work_queue(spark, sf_dir):
    return rulings.work_queue(*_done(spark, sf_dir))


@query("select (select count(*) from documents) as total, count(distinct case when quality = 1 then doc_id end) as extracted, count(distinct case when quality = 0 then doc_id end) as failed, (select count(*) from documents) - count(distinct case when quality = 1 then doc_id end) - count(distinct case when quality = 0 then doc_id end) as remaining from labels")
def progress_counts(spark, sf_dir):
    return rulings.progress(*_done(spark, sf_dir))


@query("select doc_id, source from documents order by md5('42|' || doc_id), doc_id limit 100")
def validation_sample(spark, sf_dir):
    return rulings.random_sample(_table(spark, sf_dir, "documents"), "doc_id", 100).select("doc_id", "source")


@query("select doc_id, n_chars from documents order by n_chars desc nulls last, doc_id limit 50 offset 20")
def paged_export(spark, sf_dir):
    return rulings.page(_table(spark, sf_dir, "documents").select("doc_id", "n_chars"), [F.desc_nulls_last("n_chars"), "doc_id"], 20, 50)


def _rulings(spark, sf_dir):
    """Documents as rulings: some revoked, some without tariffs, some of other categories."""
    q = F.col("doc_id")
    tariffs = F.when(q % 5 == 0, F.array().cast("array<string>")).when(q % 5 == 1, F.array(F.lit("0101.21.00"), F.lit("0102.21.00"))).otherwise(F.array(F.concat(F.lit("61"), F.lpad((q % 100).cast("string"), 2, "0"), F.lit(".20.00"))))
    category = F.when(q % 3 == 0, "Tariff Classification").when(q % 3 == 1, "Origin")
    subject = F.concat(F.lit("The tariff classification of item "), q, F.when(q % 2 == 0, " from afar.").otherwise(""))
    return _table(spark, sf_dir, "documents").select(
        q.cast("string").alias("ruling_number"), F.when(q % 11 == 0, "too short").otherwise(subject).alias("subject"), tariffs.alias("tariffs"), category.alias("categories"), F.when(q % 7 == 0, True).when(q % 7 == 1, False).alias("is_revoked"),
        F.lit("2020-01-02").alias("ruling_date"), F.col("text").alias("ruling_text"), "doc_id",
    )


_RULINGS = "r as (select cast(doc_id as varchar) as ruling_number, doc_id, text as ruling_text, case when doc_id % 11 = 0 then 'too short' else 'The tariff classification of item ' || doc_id || case when doc_id % 2 = 0 then ' from afar.' else '' end end as subject, case when doc_id % 5 = 0 then null when doc_id % 5 = 1 then '0101.21.00' else '61' || lpad(cast(doc_id % 100 as varchar), 2, '0') || '.20.00' end as first_tariff from documents)"


@query(f"with {_RULINGS} select ruling_number from r where doc_id % 3 = 0 and doc_id % 7 <> 0 and doc_id % 5 <> 0 and length(ruling_text) > 100")
def eligible_rulings(spark, sf_dir):
    """JN2, FL5."""
    r = _rulings(spark, sf_dir)
    return rulings.eligible(r.drop("ruling_text"), r.select("ruling_number", "ruling_text")).select("ruling_number")


@query(f"with {_RULINGS} select ruling_number from r where length(subject) > 20")
def subject_filter(spark, sf_dir):
    """FL6."""
    return rulings.with_subjects(_rulings(spark, sf_dir)).select("ruling_number")


@query(f"""with {_RULINGS}, b as (select *, case when doc_id % 4 = 0 then 'a machine for sorting number ' || doc_id end as product,
  case when subject = 'too short' then subject when doc_id % 2 = 0 then 'item ' || doc_id || ' from afar' when length('item ' || doc_id) > 10 then 'item ' || doc_id else subject end as cleaned from r where first_tariff is not null)
select ruling_number, first_tariff as hts_code, coalesce(product, cleaned) as description, case when product is null then 'subject' else 'ruling_text' end as description_source from b where length(coalesce(product, cleaned)) >= 10""")
def ruling_export(spark, sf_dir):
    """ST4, FL10."""
    q = F.col("doc_id")
    body = F.when(q % 4 == 0, F.concat(F.lit("Dear Sir:\n\nThe subject merchandise is a machine for sorting\n number "), q, F.lit("\n\nThe applicable heading is none."))).otherwise("No description.")
    return rulings.exported(_rulings(spark, sf_dir).withColumn("body", body), "body").select("ruling_number", "hts_code", "description", "description_source")


@query("select doc_id from documents where length(text) >= 30")
def enrichment_filter(spark, sf_dir):
    """FL8."""
    return rulings.described(_table(spark, sf_dir, "documents").withColumnRenamed("text", "enriched_description")).select("doc_id")


@query(f"with items as ({ITEMS}) select seq from items where seq % 9 <> 0 and seq % 40 between 20 and 35 and seq % 4 <> 0")
def export_filter(spark, sf_dir):
    """FL3, FL4: no failures, reasoning of 20 to 35 characters, a code of four digits."""
    q = F.col("seq")
    rows = items(spark, sf_dir).select("seq", F.when(q % 9 == 0, rulings.FAILED).otherwise("a thing").alias("description"), F.when(q % 40 > 0, F.repeat(F.lit("r"), (q % 40).cast("int"))).alias("reasoning"), F.when(q % 4 == 0, "1.0").otherwise(F.col("hts_code")).alias("hts_code"))
    return rulings.export_filter(rows, 20, 35).select("seq")


@query(f"with {_RULINGS} select ruling_number, product_idx, subject from r, (values (0), (1)) v(product_idx) where doc_id % 3 > product_idx")
def extraction_join(spark, sf_dir):
    """JN1: products without a ruling go."""
    r = _rulings(spark, sf_dir)
    extracted = r.where("doc_id % 3 > 0").select("ruling_number", F.explode(F.sequence(F.lit(0), (F.col("doc_id") % 3 - 1).cast("int"))).alias("product_idx"))
    return rulings.extractions(extracted.union(spark.createDataFrame([("unknown", 0)], "a string, b int")), r).select("ruling_number", "product_idx", "subject")


@query("select cast(doc_id as varchar) as ruling_number, 0 as product_idx, '__EXTRACTION_FAILED__' as description from documents where doc_id % 4 = 0")
def extraction_failures(spark, sf_dir):
    """SK5, ST10: rulings none of whose products survived."""
    r = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("ruling_number"), "doc_id")
    said = F.when(F.col("doc_id") % 4 == 0, '{"products":[{"description":"short"}]}').otherwise('{"products":[{"description":"a description that is long enough"}]}')
    return rulings.failure_rows(r, extraction.products(r.select("ruling_number", said.alias("content"))))


@query("select count(distinct o_custkey) as rulings, count(*) as products, sum(o_orderkey % 5000) as tokens, round(floor(sum(o_orderkey % 5000) * 0.8) * 0.20 / 1e6 + floor(sum(o_orderkey % 5000) * 0.2) * 1.25 / 1e6, 2) as cost from orders")
def extraction_totals(spark, sf_dir):
    """AG18."""
    return extraction.totals(_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("ruling_number"), (F.col("o_orderkey") % 5000).alias("tokens_used")))


@query(f"""with items as ({ITEMS}), r as (select *, case when seq % 4 <> 3 then hts_code end as code from items), m as (select median(length(description)) as median_len from r)
select count(*) as total, min(length(description)) as min_len, max(length(description)) as max_len, avg(length(description)) as mean_len, any_value(median_len) as median_len, count_if(code is not null) as with_code,
  count_if(seq % 4 = 1 or (seq % 4 <> 3 and substr({_N},1,8) = '01012100')) as agreeing, count(*) - count(distinct ruling_number) as extra_products, count_if(coalesce(lang,'')<>'') as with_lang from r, m""")
def sample_summary(spark, sf_dir):
    """AG19."""
    q = F.col("seq")
    rows = items(spark, sf_dir).withColumn("tariffs", F.array(F.lit("0101.21.00"), F.when(q % 4 == 1, F.substring("hts_code", 1, 10)))).withColumn("hts_code", F.when(q % 4 != 3, F.col("hts_code")))
    return rulings.sample_summary(rows, ["lang"])


@query("select doc_id, case when doc_id % 3 = 0 then 'a,b ' || doc_id when doc_id % 3 = 1 then '' else '' end as members, case when doc_id % 3 = 0 then 2 else 0 end as n from documents")
def decoded_lists(spark, sf_dir):
    """ST12: a list in JSON; what is none is empty."""
    q = F.col("doc_id")
    said = F.when(q % 3 == 0, F.concat(F.lit('["a","b '), q, F.lit('"]'))).when(q % 3 == 1, "not json")
    found = rulings.decoded_list("said")
    return _table(spark, sf_dir, "documents").withColumn("said", said).select("doc_id", F.array_join(found, ",").alias("members"), F.size(found).alias("n"))


@query("select doc_id, 'Ruling: N' || doc_id || chr(10) || 'Tariffs: 0101, 0102' || chr(10) || chr(10) || lang as prompt from documents")
def extraction_prompt(spark, sf_dir):
    """ST11."""
    return _table(spark, sf_dir, "documents").select("doc_id", extraction.prompt(F.concat(F.lit("N"), F.col("doc_id")), F.array(F.lit("0101"), F.lit("0102")), F.col("lang")).alias("prompt"))


@query("select doc_id, 'one' || chr(10) || chr(10) || lang || chr(10) || 'two' as body from documents")
def clean_tiers(spark, sf_dir):
    """ST5."""
    body = F.concat(F.lit("Correction to Ruling N1 of May\r\n \r\none\r\n\r\n\n\n"), F.col("lang"), F.lit("\rtwo \n"))
    return _table(spark, sf_dir, "documents").select("doc_id", text.clean_tier(body).alias("body"))


@query("select conv_id, turn, 'HTS 0101.21.00' as gold from conversations where turn > 0 and conv_id % 2 = 0")
def benchmark_rows(spark, sf_dir):
    """FL13, ST26: rows of two messages or more that have a gold code."""
    said = F.when(F.col("conv_id") % 2 == 0, "HTS US Code -> 0101.21.00").otherwise("HTS US Code -> none")
    rows = _table(spark, sf_dir, "conversations").withColumn("messages", F.array_repeat(F.struct("role", said.alias("content")), (F.col("turn") + 1).cast("int")))
    return extraction.benchmark(rows).select("conv_id", "turn", F.concat(F.lit("HTS "), F.array_join("hts_code", ",")).alias("gold"))


@query("select c_custkey as k, c_acctbal as v from customer where c_custkey % 3 <> 0 union all select c_custkey, c_acctbal + 1 from customer where c_custkey % 3 = 0")
def upsert_merge(spark, sf_dir):
    old = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    return rulings.upserted(old, old.where("k % 3 = 0").withColumn("v", F.col("v") + 1), ["k"])


@query("select o_orderkey as k, case when o_orderkey % 1000 < 2 then 'changed' else o_orderstatus end as v, o_totalprice as p from orders union all select -1 - p_partkey, 'new', null from part where p_partkey % 500 = 0")
def keyed_upserts(spark, sf_dir):
    """SK4 on a stored table: two upserts of few rows, each of which copies the buckets of its keys."""
    orders = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"), F.col("o_totalprice").alias("p"))
    table = KeyedTable.create(orders, scratch(spark), ["k"])
    table.upsert(orders.where("k % 1000 < 2").withColumn("v", F.lit("changed")))
    table.upsert(_table(spark, sf_dir, "part").where("p_partkey % 500 = 0").select((-1 - F.col("p_partkey")).alias("k"), F.lit("new").alias("v")))
    return table.read()


_U = "cast(('0x' || substr(md5('42|' || seq),1,8)) as bigint) / 4294967296.0"


@query(f"with items as ({ITEMS}) select seq, case when {_U} < 0.45 then 'rich' when {_U} < 0.45 + 0.25 then 'minimal' when {_U} < 0.45 + 0.25 + 0.2 then case when seq % 2 = 0 then 'glossary_enriched' else 'rich' end when {_U} < 1.0 then case when lang = 'en' then 'materials_only' else 'rich' end else 'rich' end as variant from items")
def variant_assign(spark, sf_dir):
    return items(spark, sf_dir).select("seq", build.variant(F.col("seq"), F.col("lang") == "en", F.col("seq") % 2 == 0).alias("variant"))


@query(f"with items as ({ITEMS}) select seq from items order by md5('42|' || seq), seq limit (select cast(floor(count(*) * cast(0.1 as double)) as bigint) from documents)")
def abstain_inject(spark, sf_dir):
    return build.abstain_rows(items(spark, sf_dir), 0.1).select("seq")


@query(f"with e as ({EXAMPLES}) select seq from (select seq, abstain, row_number() over (partition by hts_code, abstain order by md5('42|' || seq), seq) as rn from e) where rn <= 1 or abstain")
def freq_cap(spark, sf_dir):
    return build.cap_per_code(examples(spark, sf_dir), 1).select("seq")


@query(f"with items as ({ITEMS}) select seq, hts_code from items order by seq limit 50")
def head_rows(spark, sf_dir):
    return build.head(items(spark, sf_dir).select("seq", "hts_code"), 50)


_W = r"list_filter(regexp_split_to_array(description, '[ \t\n\r\f\x0B]+'), lambda w: w <> '')"
_CAT = "cast(('0x' || substr(md5('43|' || seq),1,8)) as bigint) % 3"


@query(f"with items as ({ITEMS}) select seq, array_to_string(({_W})[:3], ' ') || '...' as first_words from items")
def corrupt_first_words(spark, sf_dir):
    return items(spark, sf_dir).select("seq", text.first_words(F.col("description")).alias("first_words"))


@query(f"with items as ({ITEMS}) select ({_CAT}) as category, count(*) as n from items group by 1")
def corrupt_categories(spark, sf_dir):
    category = build.corrupted(F.col("description"), F.col("seq"))["category"]
    number = F.array_position(F.array(*map(F.lit, build.CATEGORIES)), category) - 1
    return items(spark, sf_dir).groupBy(number.alias("category")).agg(F.count("*").alias("n"))


@query(f"with items as ({ITEMS}) select cast(('0x' || substr(md5('44|' || seq),1,8)) as bigint) % 4 as template, count(*) as n, cast(sum(seq) as bigint) as seqs from items where ({_CAT}) = 0 group by 1")
def corrupt_templates(spark, sf_dir):
    """RN5: which of the vague texts a row gets."""
    found = items(spark, sf_dir).select("seq", build.corrupted(F.col("description"), F.col("seq")).alias("x")).where(F.col("x.category") == build.CATEGORIES[0])
    number = F.array_position(F.array(*map(F.lit, text.VAGUE)), F.col("x.description")) - 1
    return found.groupBy(number.alias("template")).agg(F.count("*").alias("n"), F.sum("seq").alias("seqs"))


_DEAL = "select *, case when n >= 3 then greatest(1, cast(floor(n * cast(0.1 as double)) as bigint)) else 0 end as v from r"
_SIDE = "case when n - 2*v <= 0 or rk <= n - 2*v then 'train' when rk <= n - v then 'valid' else 'test' end"
_SPLIT = f"""with e as ({EXAMPLES}), g as (select ruling_number, coalesce(arg_min(substr(hts_code,1,2), seq) filter (where not abstain), '__other__') as stratum from e where ruling_number is not null group by 1),
r as (select *, count(*) over (partition by stratum) as n, row_number() over (partition by stratum order by md5('42|' || ruling_number), ruling_number) as rk from g), q as ({_DEAL}), s as (select ruling_number, stratum, {_SIDE} as split from q)"""
_BY_ROW = f"""with e as ({EXAMPLES}), r as (select *, count(*) over (partition by stratum) as n, row_number() over (partition by stratum order by md5('42|' || seq), seq) as rk from (select *, case when abstain then '__abstain__' else substr(hts_code,1,2) end as stratum from e)),
q as ({_DEAL}), s as (select seq, ruling_number, {_SIDE} as split from q)"""


@query(f"{_SPLIT} select * from s")
def split_ruling(spark, sf_dir):
    return build.split_groups(examples(spark, sf_dir))


@query(f"{_SPLIT} select seq, coalesce(split, 'train') as split from e left join s using (ruling_number)")
def split_assigned(spark, sf_dir):
    """Rows without a ruling train."""
    return build.assigned(examples(spark, sf_dir)).select("seq", "split")


_PREPARED = f"""with items as ({ITEMS}), band as (select *, {_N} as code from items where length(description) between 20 and 4000),
once as (select band.* from band semi join (select min(seq) as seq from band group by trim(lower(description), ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)), code) using (seq)),
chosen as (select seq, true as yes from once order by md5('42|' || seq), seq limit (select cast(floor(count(*) * cast(0.2 as double)) as bigint) from once)),
turned as (select once.*, coalesce(yes, false) as abstain from once left join chosen using (seq)),
e as (select seq, ruling_number, code as hts_code, abstain from turned qualify abstain or row_number() over (partition by code, abstain order by md5('42|' || seq), seq) <= 1), """ + _SPLIT[_SPLIT.index("g as ("):]


@query(f"{_PREPARED} select coalesce(split, 'train') as split, case when abstain then 'abstention' else 'hierarchical_classify' end as task_type, count(*) as n, cast(sum(seq) as bigint) as seqs from e left join s using (ruling_number) group by all")
def prepare_run(spark, sf_dir):
    """Preparation from settings: normalised, built, capped and split; rows and a checksum of each split."""
    settings = files.filled(files.DataSettings, {"normalization": {"min_description_length": 20, "max_description_length": 4000, "dedup_minhash_threshold": 0}, "abstention": {"rate": 0.2}, "frequency_cap": {"max_per_code": 1}})
    rows = prepare.split(prepare.built(prepare.normalized(items(spark, sf_dir), settings.normalization, _checkpoint(spark)), settings), settings.split)
    return rows.groupBy("split", "task_type").agg(F.count("*").alias("n"), F.sum("seq").alias("seqs"))


@query(f"{_BY_ROW} select seq, split from s")
def split_rows(spark, sf_dir):
    return build.split_rows(examples(spark, sf_dir)).select("seq", "split")


@query(f"{_BY_ROW} select count_if(split='train') as train, count_if(split='valid') as valid, count_if(split='test') as test, count(*) as total from s")
def split_summary(spark, sf_dir):
    return audit.split_summary(build.split_rows(examples(spark, sf_dir)))


@query(f"{_BY_ROW} select ruling_number, count(distinct split) as n_splits from s where ruling_number is not null group by 1 having count(distinct split) > 1")
def split_isolation(spark, sf_dir):
    """JN10 on the split by rows, which does leak; the split by rulings is held against its own SQL."""
    return build.leaking_groups(build.split_rows(examples(spark, sf_dir)))


@query(f"with items as ({ITEMS}), q as (select lang, count(*) as c, row_number() over (order by lang) as i, count(*) over () as k from items group by lang), z as (select lang, case when i < k then greatest(1, 100 * c // (select count(*) from items)) else 100 - (select sum(greatest(1, 100 * c // (select count(*) from items))) from q where i < k) end as quota from q), r as (select seq, lang, row_number() over (partition by lang order by md5('42|' || seq), seq) as rn from items) select seq, r.lang from r join z on r.lang = z.lang where rn <= quota")
def stratified_subset(spark, sf_dir):
    return build.stratified(items(spark, sf_dir), "lang", 100).select("seq", "lang")


_TERMS = ("that", "with", "from", "the and", "of")


@query(rf"with items as ({ITEMS}), m as (select seq, unnest(list_distinct(list_transform(regexp_extract_all(description, '(?i)\b(the and|from|that|with)\b', 1), lambda x: lower(x)))) as term from items), r as (select *, row_number() over (partition by seq order by md5('42|' || term), term) as rn from m) select seq, string_agg(term, ',' order by rn) as terms from r where rn <= 3 group by seq")
def glossary_match(spark, sf_dir):
    found = dictionary.glossary_matches(items(spark, sf_dir), spark.createDataFrame([(t,) for t in _TERMS], "term string"))
    return found.where(F.size("terms") > 0).select("seq", F.array_join("terms", ",").alias("terms"))


@query(rf"with items as ({ITEMS}), m as (select seq, unnest(list_distinct(list_transform(regexp_extract_all(description, '(?i)\b(the and|from|that|with)\b', 1), lambda x: lower(x)))) as term from items), r as (select *, row_number() over (partition by seq order by md5('42|' || term), term) as rn from m), f as (select seq, string_agg(term || '=on ' || term, ';' order by rn) as terms from r where rn <= 2 group by seq) select seq, coalesce(terms, '') as terms from items left join f using (seq)")
def glossary_definitions(spark, sf_dir):
    """JN7 with definitions."""
    glossary = spark.createDataFrame([(t.title(), f"on {t}") for t in _TERMS], "term string, definition string")
    found = dictionary.glossary_defined(items(spark, sf_dir), glossary, most=2)
    return found.select("seq", F.array_join(F.transform("terms", lambda t: F.concat(t["term"], F.lit("="), t["definition"])), ";").alias("terms"))


_SETS = r"""l as (select doc_id as id, list_filter(regexp_split_to_array(lower(text), '[ \t\n\r\f\x0B]+'), lambda x: x <> '') as w from documents),
u as (select id, unnest(w) as w, generate_subscripts(w, 1) as i from l),
t as (select id, w || chr(1) || lead(w) over o || chr(1) || lead(w, 2) over o as s from u window o as (partition by id order by i)),
sh as (select distinct id, s from t where s is not null union all select id, '-' from l where len(w) < 3),
n as (select id, count(*) as n from sh group by 1)"""
_SH = f"""{_SETS},
z as (select id, list_sort(list(s)) as s from sh group by id), reps as (select s, min(id) as rep from z group by s), own as (select id, rep from z join reps using (s)),
u2 as (select sh.* from sh semi join reps on sh.id = reps.rep),
p as (select x.id as a, y.id as b, count(*) as m from u2 x join u2 y on x.s = y.s and x.id < y.id group by 1, 2)"""


def _sets(spark, sf_dir):
    return normalize.with_shingles(_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"), "text").select("id", "sh")


@query(f"with {_SH} select a, b, m / (x.n + y.n - m) as jaccard from p join n x on x.id = a join n y on y.id = b where m / (x.n + y.n - m) >= 0.8")
def neardup_pairs(spark, sf_dir):
    s = _sets(spark, sf_dir)
    return normalize.similar_pairs(s, s, 0.8, same=True)


@query(f"with {_SH} select id, rep from own")
def neardup_members(spark, sf_dir):
    """The representative of each row's set, which stands for it in neardup_pairs."""
    return normalize.representatives(_sets(spark, sf_dir))


_GREEDY = f"""with recursive {_SH}, near as (select a, b from p join n x on x.id = a join n y on y.id = b where m / (x.n + y.n - m) >= 0.8),
turn as (select b, list(a) as earlier, row_number() over (order by b) as k from near group by b),
state(k, dropped) as (select cast(0 as bigint), cast([] as bigint[]) union all select turn.k, case when len(list_filter(earlier, lambda x: not list_contains(dropped, x))) > 0 then list_append(dropped, b) else dropped end from state join turn on turn.k = state.k + 1),
gone as (select unnest(dropped) as id from state where k = (select max(k) from state))"""


@query(f"{_GREEDY} select rep as doc_id from reps where rep not in (select id from gone)")
def fuzzy_dedup(spark, sf_dir):
    """Greedy keep-first removal, in SQL one row after another. Copies go with their first one."""
    s = _sets(spark, sf_dir)
    dropped = normalize.greedy_keep(normalize.decisive_pairs(s, 0.8), _checkpoint(spark))
    kept = normalize.first_ids(s).withColumnRenamed("id", "doc_id")
    return kept.join(dropped.withColumnRenamed("id", "doc_id"), "doc_id", "left_anti")


def _checkpoint(spark: SparkSession):
    """Cuts lineage by a table in the shared folder, which is written once and survives lost executors."""

    def written(df: DataFrame) -> DataFrame:
        path = scratch(spark)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return written


@query(f"with {_SETS}, q as (select x.id as a, y.id as b, count(*) as m from sh x join sh y on x.s = y.s and x.id % 5 > 1 and y.id % 5 < 2 group by 1, 2) select case when b % 5 = 0 then 'valid_vs_train' else 'test_vs_train' end as kind, count(distinct b) as n from q join n x on x.id = a join n y on y.id = b where m / (x.n + y.n - m) >= 0.85 group by 1")
def leakage_counts(spark, sf_dir):
    """ND4: rows of valid and test that are like a row of train."""
    split = F.when(F.col("id") % 5 == 0, "valid").when(F.col("id") % 5 == 1, "test").otherwise("train")
    return normalize.leakage(_sets(spark, sf_dir).withColumn("split", split))


_ASSIST = f"'<think>' || chr(10) || '</think>' || chr(10) || chr(10) || 'Chapter ' || substr({_N},1,2) || ': ' || source || chr(10) || 'Heading ' || substr({_N},1,2) || '.' || substr({_N},3,2) || ': ' || lang || chr(10) || 'Subheading ' || substr({_N},1,4) || '.' || substr({_N},5,2) || ': part' || chr(10) || 'HTS Code: ' || hts_code || chr(10) || chr(10) || 'Reasoning: Classified under ' || hts_code || ' based on product description.' || chr(10) || chr(10) || 'Provides for: part'"


def _answers(spark, sf_dir):
    none = F.lit(None).cast("string")
    return items(spark, sf_dir).withColumn("answer", chat.answer(F.col("hts_code"), F.col("source"), F.col("lang"), F.lit("part"), none, none))


@query(f"with items as ({ITEMS}) select seq, {_ASSIST} as answer from items")
def format_assistant(spark, sf_dir):
    return _answers(spark, sf_dir).select("seq", "answer")


_PROMPT = """case seq % 5 when 1 then 'Product: ' || ruling_number when 2 then 'Product: ' || ruling_number || case when seq % 3 = 0 then chr(10) || chr(10) || 'Relevant trade terms:' || chr(10) || '- a: b' || chr(10) || '- c: ' || lang else '' end
  when 3 then case when seq % 3 = 0 then 'Product: ' || ruling_number else 'Materials: ' || source || chr(10) || 'Country of origin: ' || lang end
  else 'Product: ' || ruling_number || case when seq % 3 = 0 then '' else chr(10) || 'Materials: ' || source || chr(10) || 'Country of origin: ' || lang end end"""


def _asked(rows):
    """Columns materials, use, country, terms, of which some are empty."""
    q, some = F.col("seq"), F.col("seq") % 3 != 0
    pair = lambda t, d: F.struct(F.lit(t).alias("term"), d.alias("definition"))
    return rows.withColumns({"materials": F.when(some, F.col("source")).otherwise(""), "use": F.lit(None).cast("string"), "country": F.when(some, F.col("lang")), "terms": F.when(~some, F.array(pair("a", F.lit("b")), pair("c", F.col("lang"))))})


@query(f"with items as ({ITEMS}) select seq, {_PROMPT} as prompt from items")
def format_user(spark, sf_dir):
    """ST20: all four variants, with and without what they show, and an unknown one."""
    variant = F.element_at(F.array(*map(F.lit, ("rich", "minimal", "glossary_enriched", "materials_only", "unknown"))), (F.col("seq") % 5 + 1).cast("int"))
    rows = _asked(items(spark, sf_dir))
    return rows.select("seq", chat.user_prompt(variant, F.col("ruling_number"), F.col("materials"), F.col("use"), F.col("country"), F.col("terms")).alias("prompt"))


@query(f"with e as ({EXAMPLES}) select seq, 3 as n_messages, 'system,user,assistant' as roles, case when abstain or input_variant = 'minimal' or input_variant = 'glossary_enriched' then 'Product: ' || lang when input_variant = 'rich' then 'Product: ' || lang || chr(10) || 'Materials: ' || source else 'Materials: ' || source end as asked, case when abstain then case abstain_category when 'missing_materials' then 'material composition' when 'ambiguous_use' then 'intended use' else 'too vague' end else 'HTS Code: ' || hts_code end as said, abstain from e")
def chat_examples(spark, sf_dir):
    """ST22, ST23: abstentions ask with the product alone and say why."""
    none = F.lit(None).cast("string")
    e = examples(spark, sf_dir).withColumns({"materials": F.col("source"), "product_use": none, "country": none, "chapter_description": none, "heading_description": none, "tariff_description": none, "reasoning": none, "hts_text": none}).withColumn("description", F.col("lang"))
    m = e.select("seq", "abstain", "hts_code", chat.example(F.struct(*e.columns)).alias("m"))
    reply = F.col("m")[2]["content"]
    said = F.when(F.contains(reply, F.lit("HTS Code: ")), F.regexp_extract(reply, "HTS Code: [0-9.]+", 0)).otherwise(F.regexp_extract(reply, "too vague|material composition|intended use", 0))
    return m.select("seq", F.size("m").alias("n_messages"), F.array_join(F.transform("m", lambda x: x["role"]), ",").alias("roles"), F.col("m")[1]["content"].alias("asked"), said.alias("said"), "abstain")


@query(f"with items as ({ITEMS}) select seq, case when seq % 3 = 0 then 'minimal' else 'rich' end as by_fields, case when seq % 4 = 0 then 'own words' when seq % 4 = 1 then 'Product: ' || lang when seq % 3 = 0 then 'Product: ' || lang else 'Product: ' || lang || chr(10) || 'Materials: ' || source || chr(10) || 'Country of origin: ' || lang end as asked, 2 as n from items")
def chat_requests(spark, sf_dir):
    """ST24, ST25: a record's own messages go first; `variant` goes before `input_variant`."""
    q, c = F.col("seq"), F.col
    say = lambda r, t: F.struct(F.lit(r).alias("role"), F.lit(t).alias("content"))
    own = F.when(q % 4 == 0, F.array(say("system", "s"), say("user", "own words"), say("assistant", "gone")))
    rows = _asked(items(spark, sf_dir))
    m = chat.request(own, F.when(q % 4 == 1, "minimal"), F.when(q % 4 == 1, "rich"), c("lang"), c("materials"), c("use"), c("country"))
    return rows.select("seq", chat.request_variant(c("materials"), c("use"), c("country")).alias("by_fields"), m[1]["content"].alias("asked"), F.size(m).alias("n"))


@query(f"with items as ({ITEMS}) select seq, case when seq % 4 = 0 then '' else hts_code end as hts_code, seq % 4 = 0 as abstain, case when seq % 2 = 0 then 'body ' || lang else 'no tag' end as body from items")
def pilot_records(spark, sf_dir):
    """ST28, ST29."""
    q = F.col("seq")
    said = F.when(q % 2 == 0, F.concat(F.lit(chat.THINK + "body "), F.col("lang"))).otherwise("no tag")
    a = chat.adapted(F.when(q % 4 == 0, chat.ABSTAINED).otherwise(F.col("hts_code")))
    return items(spark, sf_dir).select("seq", a["hts_code"].alias("hts_code"), a["abstain"].alias("abstain"), chat.expected_body(said).alias("body"))


def _said(spark, sf_dir):
    """Answers of six kinds: whole; without headings; sections in another order; abstentions; garbage; undotted levels."""
    c, q = F.col("hts_code"), F.col("seq")
    part = lambda i, n: F.substring(codes.normalized(c), i, n)
    odd = F.concat(F.lit("Provides for: parts\nof it\n\nReasoning: it is\n\nHTS Code: "), c, F.lit("\nChapter "), part(1, 2), F.lit(": last"))
    bare = F.concat(F.lit("Heading "), part(1, 4), F.lit(": h\nSubheading "), part(1, 6), F.lit(": s\nHTS Code: "), c)
    short = F.concat(F.lit("<think>\nhm\n</think>\nHTS Code: "), c, F.lit("\nReasoning: none"))
    other = F.when(q % 6 == 1, short).when(q % 6 == 2, odd).when(q % 6 == 3, chat.abstention(F.lit("ambiguous_use"))).when(q % 6 == 4, "I do not know").when(q % 6 == 5, bare)
    return _answers(spark, sf_dir).withColumn("answer", F.coalesce(other, F.col("answer")))


_H, _S = f"substr({_N},1,2) || '.' || substr({_N},3,2)", f"substr({_N},1,4) || '.' || substr({_N},5,2)"


@query(f"""with items as ({ITEMS}), k as (select *, seq % 6 as k, seq % 6 in (3, 4) as none from items) select seq, case when not none then substr({_N},1,2) end as chapter_code, case k when 0 then source when 2 then 'last' end as chapter_desc, case when not none then {_H} end as heading_code,
  case k when 0 then lang when 5 then 'h' end as heading_desc, case when not none then {_S} end as subheading_code, case k when 0 then 'part' when 5 then 's' end as subheading_desc, case when not none then hts_code end as hts_code,
  case k when 0 then 'Classified under ' || hts_code || ' based on product description.' when 1 then 'none' when 2 then 'it is' end as reasoning, case k when 0 then 'part' when 2 then 'parts' || chr(10) || 'of it' end as provides_for, k = 3 as is_abstention, k <> 4 as parse_ok from k""")
def roundtrip(spark, sf_dir):
    names = ("chapter_code", "chapter_desc", "heading_code", "heading_desc", "subheading_code", "subheading_desc", "hts_code", "reasoning", "provides_for", "is_abstention", "parse_ok")
    return _said(spark, sf_dir).select("seq", chat.parsed(F.col("answer")).alias("p")).select("seq", *[f"p.{c}" for c in names])


@query(f"""with items as ({ITEMS}), k as (select *, seq % 6 as k, seq % 6 in (3, 4) as none from items) select seq, case when not none then substr({_N},1,2) end as chapter, case k when 0 then lang when 5 then 'h' end as heading_description, not none as has_levels, case when k = 4 then 'I do not know' end as raw, k <> 4 as parse_ok from k""")
def response_struct(spark, sf_dir):
    """ST30: the nested answer; raw only where parsing failed."""
    r = _said(spark, sf_dir).select("seq", "answer", chat.parsed(F.col("answer")).alias("p")).select("seq", chat.response(F.col("p"), F.col("answer")).alias("r"))
    return r.select("seq", F.col("r.chapter.code").alias("chapter"), F.col("r.heading.description").alias("heading_description"), F.col("r.subheading").isNotNull().alias("has_levels"), "r.raw", "r.parse_ok")


@query("select conv_id, turn, '<|begin_of_text|><|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) || text || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) || '<think>' || chr(10) || '</think>' || chr(10) || chr(10) as prompt from conversations")
def chat_render(spark, sf_dir):
    one = F.array(F.struct("role", F.col("text").alias("content")))
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", chat.rendered(one).alias("prompt"))


@query(f"with items as ({ITEMS}) select seq, 'item ' || ruling_number || ' from ' || source as subject from items")
def subject_clean(spark, sf_dir):
    body = F.concat(F.lit("item "), F.col("ruling_number"), F.lit(" from "), F.col("source"))
    given = F.concat(F.when(F.col("seq") % 2 == 0, "RE: The tariff classification of ").otherwise("Classification of "), body, F.lit("."))
    return items(spark, sf_dir).select("seq", text.clean_subject(given).alias("subject"))


@query(f"with items as ({ITEMS}) select seq, 'a thing made in ' || lang || ' for ' || ruling_number as product, 'The applicable heading for it is ' || substr(hts_code,1,4) || ', which provides for things.' as reasoning from items")
def section_extract(spark, sf_dir):
    body = F.concat(F.lit("Dear Sir:\n\nThe subject product is a thing\r\nmade in "), F.col("lang"), F.lit("  for "), F.col("ruling_number"), F.lit("\n\nThe applicable heading for it is "), F.substring("hts_code", 1, 4), F.lit(", which provides for things.\n"))
    return items(spark, sf_dir).select("seq", text.product_description(body).alias("product"), text.ruling_reasoning(body).alias("reasoning"))


@query(f"with items as ({ITEMS}) select seq, hts_code || ',0101.21.00' as gold, 'a thing' as product from items")
def gold_extract(spark, sf_dir):
    said = F.concat(F.lit("HTS US Code -> "), F.col("hts_code"), F.lit("; 0101.21.00 or "), F.col("hts_code"), F.lit("\nReasoning: see 9999.99.99"))
    return items(spark, sf_dir).select("seq", F.array_join(text.gold_codes(said), ",").alias("gold"), text.question_product(F.lit("What is the HTS US Code for a thing?")).alias("product"))


_PART = "'part of order number ' || k"


@query(f"""with o as (select o_orderkey as k, o_orderkey % 8 as kind from orders), two as (select *, unnest([1, 3]) as product_idx from o where kind not in (4, 6))
select cast(k as varchar) as ruling_number, product_idx, case when product_idx = 3 then 'a second part, "quoted"' else {_PART} end as description, case when product_idx = 1 and k % 3 > 0 then '0101.21.0010' when product_idx = 3 then '101' || k % 10 end as hts_code,
  case when product_idx = 1 and kind = 7 then '["oak","ash"]' end as materials, case when product_idx = 1 then 'pressing' end as product_use, null as reasoning, case when product_idx = 3 then 'Other' end as hts_text,
  case when kind in (2, 7) then null when kind = 3 then '7' else 'Peru' end as country, k % 5000 as tokens_used from two""")
def llm_json_explode(spark, sf_dir):
    """ST6-ST9: answers in bare JSON, after words, after a scalar, cut off, as a list, with NULs, without or with odd countries; products that are none, too short, with lists and numbers for texts."""
    k = F.col("o_orderkey")
    kind = k % 8
    first = F.concat(F.lit('{"description":" part of order number '), k, F.when(kind == 5, "\\u0000").otherwise(""), F.lit(' ","product_use":"pressing","materials":'), F.when(kind == 7, '["oak","ash"]').otherwise('" "'), F.lit(',"country":"elsewhere","hts_code":"'), F.when(k % 3 == 0, "n/a").otherwise("0101.21.0010"), F.lit('"}'))
    second = F.concat(F.lit('{"description":"a second part, \\"quoted\\"","hts_text":" Other","hts_code":101'), k % 10, F.lit("}"))
    country = F.when(kind == 2, "").when(kind == 3, ',"country":7').when(kind == 7, ',"country":null').otherwise(',"country":" Peru "')
    answer = F.concat(F.lit('{"products":[{"description":"short"},'), first, F.lit(',"none",'), second, F.when(kind == 4, "").otherwise(F.concat(F.lit("]"), country, F.lit("}"))))
    body = F.when(kind == 0, F.concat(F.lit("Here it is:\n"), answer, F.lit("\nDone."))).when(kind == 1, F.concat(F.lit("5 "), answer)).when(kind == 6, F.concat(F.lit("["), answer, F.lit("]"))).otherwise(answer)
    answers = _table(spark, sf_dir, "orders").select(k.cast("string").alias("ruling_number"), body.alias("content"), (k % 5000).alias("tokens_used"))
    return extraction.products(answers).drop("raw_response")


@query("select 'tariff ' || p_size as term, p_name as definition, p_type as category, 'hts_glossary (source_count=' || p_size || ')' as source, 2 as senses from part union all select 'tariff ' || p_size, p_brand, null, 'hts_glossary (source_count=' || p_size || ')', 2 from part")
def glossary_flatten(spark, sf_dir):
    sense = lambda d, c: F.struct(F.col(d).alias("definition"), c.alias("category"))
    g = _table(spark, sf_dir, "part").select(F.concat(F.lit("tariff "), F.col("p_size")).alias("term"), F.array(sense("p_name", F.col("p_type")), sense("p_brand", F.lit(None).cast("string"))).alias("senses"), F.col("p_size").alias("source_count"))
    return rulings.flat_glossary(g)


@query("select date_trunc('hour', ts) as window_start, event_type, count(*) as n, sum(value) as total from events group by 1, 2")
def events_tumbling(spark, sf_dir):
    """Beyond the reference."""
    return queue.tumbling(_table(spark, sf_dir, "events"))
