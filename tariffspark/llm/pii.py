"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base spans come from four patterns with checks (IP parts, Luhn, digit counts). Candidates are blank-separated
tokens with a digit or an at sign; numbers that only single blanks part are one. A candidate that holds a base
span is a seed entity of its kind. Seeds of the kind `secret` are quoted hexadecimal strings of 32 digits or more
that are assigned to a name of credentials, and of these only the half that begins with 0 to 7: what stands under
that name otherwise has to be found by its context, which also shows what contexts are worth. The words around a
candidate are its lexical patterns: two before, one before, one after, one on either side, if a letter is among
them. Distinct (pattern, instance) pairs are the graph, scored in rounds:

- a pattern's score for a kind is the mass of its instances of that kind (seeds 1, others their own score)
  over the instances that count: those of another kind and those whose form cannot be of the kind, among them
  numbers that failed its check, count fully, undecided ones UNKNOWN each. It needs the support of `min_seeds`
  instances that are seeds or were accepted in an earlier round, and vouches for others from SPECIFIC on if it has
  two words; a single word, which stands in more places, needs `confident`;
- an instance's score is that of its best pattern, in this round or before, among those of a kind its form allows; at
  `confident` it is accepted, supports its other patterns from then on, and is a span of the kind wherever it occurs.

The rounds end when no score grows, or after `rounds` if a caller sets it. Seeds of `secret` are spans, too.

Null and empty texts: no spans. Repeated rows: the same spans each. A text without candidates costs one
scan; the work is linear in a text's length, and in its number of hits but for blocks of BLOCK hits, whatever
the length of words. Only (key, text) are read; a null key is kept. Positions are code points, ends exclusive.
Candidates that tie between kinds take the first listed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: The four kinds of base spans, and one that only the method finds.
KINDS = ("email", "ip", "card", "phone", "secret")
SECRET = KINDS.index("secret")
MIN_SEEDS = 5
CONFIDENT = 0.9
UNKNOWN = 0.1
#: The score from which a pattern of two words vouches (their hashes are odd); one of a single word needs `confident`.
SPECIFIC = 0.6
BLOCK = 256
#: The patterns of the base spans, with possessive and look-behind forms that keep Java's matcher linear and off the stack.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BLANK, _SOLID = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
_NUMBER = r"[0-9][0-9().-]*+"
CANDIDATE = rf"(?<!{_SOLID})(?:[+(]*+{_NUMBER}(?:\x20\(?{_NUMBER})*+(?!{_SOLID})|[^\x20\x09-\x0D0-9@]*+[0-9@]{_SOLID}*+)"
#: Signs around a candidate that are not part of it.
_OPENING, _CLOSING = "\"'`<[{*#$%&|!", "\"'`>]}*#$%&|!.,;:?"
_SEED_SECRET = r"^[\"'][0-7][0-9A-Fa-f]{31,}[\"']"
_CREDENTIALS = r"(?i)(?:token|secret|passw(?:or)?d|passphrase|(?:api|access|private)[_-]?key|credentials?)[_A-Z0-9]*\x20?[=:]\x20?\z"
#: Forms that an instance of a kind may have; a form of digits alone must also pass the kind's check.
_FORMS = (
    r"(?i)@|[-_.(\[]at[-_.)\]]",
    r"^[0-9A-Fa-fXx*]*+(?:[.:][0-9A-Fa-fXx*]*+){3,}$",
    r"^(?=.*[0-9])[0-9Xx*](?:[\x20-]?[0-9Xx*]){11,18}$",
    r"^(?:[^0-9]*[0-9]){7,15}[^0-9]*$",
    r"^(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9_+/=-]{8,}$",
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value worked out once, however often body's own lambdas mention it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _is_ip(hit: Column) -> Column:
    part = lambda p: F.ltrim(p, F.lit("0"))
    return F.forall(F.split(hit, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(F.substring(part(p), 1, 3).try_cast("int"), F.lit(0)) <= 255))


def _is_card(hit: Column) -> Column:
    digits = _digits(hit)
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.ascii(F.substr(digits, n - i, F.lit(1))) - 48
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    luhn = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step) % 10 == 0
    return F.when(n.between(12, 19), luhn).otherwise(F.lit(False))


def _is_phone(hit: Column) -> Column:
    return F.length(_digits(hit)).between(9, 15)


_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _placed(steps: Column, place: Callable[[Column, Column], Column], kind: str) -> Column:
    """place(step, start) for each of steps(gap, n, ..), starts being the running sum of gaps and lengths.

    A fold that appends to an array copies it each time, so blocks of BLOCK are folded, and then their totals.
    """
    none = F.array().cast(f"array<{kind}>")

    def run(all_steps: Column) -> Column:
        n_blocks = F.ceil(F.size(all_steps) / BLOCK).cast("int")
        cut = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: F.slice(all_steps, b * BLOCK + 1, F.lit(BLOCK)))
        totals = F.transform(cut, lambda part: F.aggregate(part, F.lit(0), lambda t, x: t + x["gap"] + x["n"]))
        starts = F.aggregate(totals, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda s, t: F.struct((s["at"] + t).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

        def fold(part: Column, first: Column) -> Column:
            def step(state: Column, x: Column) -> Column:
                at = state["at"] + x["gap"]
                return F.struct((at + x["n"]).alias("at"), F.concat(state["out"], F.array(place(x, at))).alias("out"))

            return F.aggregate(part, F.struct(first.alias("at"), none.alias("out")), step, lambda s: s["out"])

        return F.flatten(F.zip_with(cut, starts, fold))

    return _let(steps, lambda v: F.when(F.size(v) > 0, run(v)).otherwise(none))


def _hits(text: Column, pattern: str, kind: int, passes) -> Column:
    """Spans of the matches that pass."""
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    steps = _let(hits, lambda h: F.zip_with(h, F.slice(gaps, 1, F.size(h)), lambda x, g: F.struct(F.length(g).alias("gap"), F.length(x).alias("n"), passes(x).alias("ok"))))
    span = lambda x, at: F.struct(at.alias("start"), F.lit(kind).alias("kind"), (at + x["n"]).alias("end"), x["ok"].alias("ok"))
    placed = _placed(steps, span, "struct<start:int,kind:int,end:int,ok:boolean>")
    return F.transform(F.filter(placed, lambda s: s["ok"]), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end>> in order; kind is the place in KINDS. A cheap look at the text comes first."""
    none = F.array().cast(_SPAN)
    digit = text.rlike("[0-9]")
    return F.array_sort(
        F.concat(
            F.when(F.instr(text, "@") > 0, _hits(text, EMAIL, 0, lambda h: F.lit(True))).otherwise(none),
            F.when(digit & text.rlike(IP), _hits(text, IP, 1, _is_ip)).otherwise(none),
            F.when(digit & text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), _hits(text, CARD, 2, _is_card)).otherwise(none),
            F.when(digit & (F.instr(text, "+") > 0), _hits(text, PHONE, 3, _is_phone)).otherwise(none),
        )
    )


_PLACE = "struct<start:int,hit:string,before:string,after:string>"


_LAST_WORDS = rf"(?<!{_SOLID})(?:{_SOLID}++{_BLANK}++){{1,2}}\z"
_NEXT_WORD = rf"^{_BLANK}++{_SOLID}++"


def _candidates(text: Column) -> Column:
    """array<struct<start, hit, before, after>>: the candidates, the two words before and the one after them."""
    hits, gaps = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), F.split(text, CANDIDATE, -1)

    def steps(v: Column) -> Column:
        around = F.zip_with(F.slice(v["gaps"], 1, F.size(v["hits"])), F.slice(v["gaps"], 2, F.size(v["hits"])), lambda b, a: F.struct(F.length(b).alias("gap"), F.regexp_extract(b, _LAST_WORDS, 0).alias("before"), F.regexp_extract(a, _NEXT_WORD, 0).alias("after")))
        return F.zip_with(v["hits"], around, lambda h, g: F.struct(g["gap"].alias("gap"), F.length(h).alias("n"), h.alias("hit"), g["before"].alias("before"), g["after"].alias("after")))

    place = lambda x, at: F.struct(at.alias("start"), x["hit"].alias("hit"), x["before"].alias("before"), x["after"].alias("after"))
    return _placed(_let(F.struct(hits.alias("hits"), gaps.alias("gaps")), steps), place, _PLACE)


def _described(places: DataFrame) -> DataFrame:
    """Rows (key, text_hash, start, hit, before, after) as (.., start, end, instance, seed, may, patterns).

    may: a flag for each kind that the form allows.
    """
    c = F.col
    last = lambda n: F.lower(F.regexp_extract("before", rf"(?<!{_SOLID})(?:{_SOLID}++{_BLANK}++){{{n}}}\z", 0))
    two, one, right = last(2), last(1), F.lower(F.regexp_extract("after", rf"^{_BLANK}++({_SOLID}++)", 1))
    says = lambda *words: F.concat(*words).rlike(r"\p{L}")
    near = F.array_compact(F.array(
        F.when((two != "") & says(two), F.concat(F.lit("2 "), two)), F.when((one != "") & says(one), F.concat(F.lit("1 "), one)), F.when((right != "") & says(right), F.concat(F.lit("r "), right)),
        F.when((one != "") & (right != "") & says(one, right), F.concat(F.lit("b "), one, F.lit("_ "), right)),
    ))
    bare = F.ltrim(F.rtrim(c("hit"), F.lit(_CLOSING)), F.lit(_OPENING))
    lead = F.length("hit") - F.length(F.ltrim(c("hit"), F.lit(_OPENING)))
    base = F.get(base_spans(c("hit")), F.lit(0))["kind"]
    secret = c("hit").rlike(_SEED_SECRET) & c("before").rlike(_CREDENTIALS)
    d = places.select("key", "text_hash", (c("start") + lead).alias("start"), bare.alias("bare"), F.transform(near, lambda p: F.xxhash64(p).bitwiseAND(F.lit(-2)) + p.rlike("^[2b]").cast("long")).alias("patterns"), F.coalesce(base, F.when(secret, SECRET)).alias("seed"))
    digits = _digits(c("bare"))
    checked = [F.lit(True), ~c("bare").rlike(rf"^{IP}$"), ~(digits.rlike("^[0-9]{12,19}$") & ~c("bare").rlike("[Xx*]")), F.lit(True), F.lit(True)]
    may = [c("bare").rlike(f) & ok for f, ok in zip(_FORMS, checked, strict=True)]
    return d.where("bare <> ''").select("key", "text_hash", "start", (c("start") + F.length("bare")).alias("end"), F.xxhash64("bare").alias("instance"), "seed", F.array(*may).alias("may"), "patterns")


def _discovered(candidates: DataFrame, rounds: int | None, min_seeds: int, confident: float) -> DataFrame:
    """(instance, kind) of what the patterns vouch for; base seeds are not among them.

    An instance keeps the best score it had, in thousandths, so scores only grow and the rounds end in a fixpoint.
    """
    n_kinds = len(KINDS)
    pairs = candidates.select("instance", "seed", "may", F.explode("patterns").alias("pattern"))
    edges = materialise(pairs.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.max("may").alias("may")))
    scored, seen, done = None, None, 0
    while rounds is None or done < rounds:
        if scored is None:
            now = edges.withColumn("kind", F.col("seed")).withColumn("score", F.when(F.col("seed").isNotNull(), 1.0).otherwise(0.0))
        else:
            now = edges.join(scored, "instance", "left").withColumn("kind", F.coalesce("seed", "kind")).withColumn("score", F.when(F.col("seed").isNotNull(), 1.0).otherwise(F.coalesce("score", F.lit(0.0))))
        is_k = lambda k: F.coalesce(F.col("kind") == k, F.lit(False))
        undecided = lambda k: F.col("kind").isNull() & F.get("may", F.lit(k))
        weight = lambda k: F.when(is_k(k), F.greatest("score", F.lit(UNKNOWN))).when(undecided(k), UNKNOWN).otherwise(1.0)
        per = [F.struct((F.sum(F.when(is_k(k), F.col("score")).otherwise(0.0)) / F.sum(weight(k))).alias("score"), F.count_if(is_k(k) & (F.col("score") >= confident)).alias("support"), F.lit(-k).alias("kind")) for k in range(n_kinds)]
        best = F.array_max(F.filter(F.array(*per), lambda x: x["support"] >= min_seeds))
        patterns = now.groupBy("pattern").agg(best.alias("best")).where(F.col("best.score") >= F.when(F.pmod("pattern", F.lit(2)) == 1, SPECIFIC).otherwise(confident)).select("pattern", F.round("best.score", 3).alias("found"), (-F.col("best.kind")).alias("of"))
        vouched = now.where(F.col("seed").isNull()).select("pattern", "instance", "may").join(patterns, "pattern").where(F.get("may", F.col("of")))
        fresh = vouched.groupBy("instance").agg(F.max(F.struct(F.col("found").alias("score"), (-F.col("of")).alias("less"))).alias("best"))
        if scored is not None:
            fresh = fresh.union(scored.select("instance", F.struct("score", (-F.col("kind")).alias("less")))).groupBy("instance").agg(F.max("best").alias("best"))
        scored = materialise(fresh.select("instance", F.col("best.score").alias("score"), (-F.col("best.less")).alias("kind")), *([scored] if scored is not None else []))
        total = scored.agg(F.count("*"), F.sum(F.xxhash64("instance", "kind", "score").cast("decimal(20,0)"))).first()
        done += 1
        if total == seen:
            break
        seen = total
    seeds = edges.where(F.col("seed") == SECRET).select("instance", "seed").distinct()
    return seeds if scored is None else scored.where(F.col("score") >= confident).select("instance", "kind").union(seeds)


def find(docs: DataFrame, key: str = "doc_id", rounds: int | None = None, min_seeds: int = MIN_SEEDS, confident: float = CONFIDENT) -> DataFrame:
    """(key, text_hash, base, spans) for each row of docs(key, text); spans hold the base ones and what was discovered."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hot = text.rlike("[0-9@]")
    empty = F.array().cast(_SPAN)
    seen = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.when(hot, base_spans(text)).otherwise(empty).alias("base"), F.when(hot, _candidates(text)).alias("places"))
    seen = materialise(seen)
    each = seen.where(F.size("places") > 0).select("key", "text_hash", F.explode("places").alias("c"))
    candidates = materialise(_described(each.select("key", "text_hash", "c.start", "c.hit", "c.before", "c.after")))
    found = materialise(_discovered(candidates, rounds, min_seeds, confident))
    spans = candidates.where(F.col("seed").isNull() | (F.col("seed") == SECRET)).select("key", "text_hash", "start", "end", "instance").join(found, "instance")
    added = spans.groupBy("key", "text_hash").agg(F.collect_set(F.struct("start", "kind", "end")).alias("added"))
    out = seen.select("key", "text_hash", "base").join(added.select(F.col("key").alias("k"), F.col("text_hash").alias("h"), "added"), F.col("key").eqNullSafe(F.col("k")) & (F.col("text_hash") == F.col("h")), "left")
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    return out.select(F.col("key").alias(key), "text_hash", "base", spans.alias("spans"))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of base spans by kind, the base spans' hash, all spans as text, and how many they are."""
    named = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select(key, *map(count, range(SECRET)), F.sha2(named("base"), 256).alias("base_sha256"), named("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


#: Texts are cut into parts of so many code points before spans are taken out of them: finding a place in a string costs its length.
PART = 4096


def _replaced(text: Column, spans: Column) -> Column:
    """The text with the spans (in order, not empty) as labels; of overlapping ones the first names what they cover together."""
    label = lambda s: F.element_at(F.array(*[F.lit(f"<{k}>") for k in KINDS]), s["kind"] + 1)
    parts = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.length(text) - 1, F.lit(0)) / PART).cast("int")), lambda b: F.substr(text, b * PART + 1, F.lit(PART)))

    def body(v: Column) -> Column:
        # ends of what came before each span: a running maximum, in blocks
        reach = _running_reach(v["spans"])
        kept = F.zip_with(v["spans"], reach, lambda s, r: F.struct(s.alias("s"), r.alias("r")))

        def slices(a: Column, b: Column) -> Column:
            first, final = F.floor(a / PART).cast("int"), F.floor((b - 1) / PART).cast("int")
            cut = F.transform(F.sequence(first, final), lambda k: _let(F.greatest(a, k * PART), lambda x: F.substr(F.element_at(v["parts"], k + 1), x - k * PART + 1, F.least(b, (k + 1) * PART) - x)))
            return F.when(b > a, F.array_join(cut, "")).otherwise(F.lit(""))

        before = F.transform(kept, lambda x: F.when(x["s"]["start"] >= x["r"], F.concat(slices(x["r"], x["s"]["start"]), label(x["s"]))).otherwise(F.lit("")))
        last = F.array_max(F.transform(v["spans"], lambda s: s["end"]))
        return F.concat(F.array_join(before, ""), slices(last, v["n"]))

    return _let(F.struct(parts.alias("parts"), spans.alias("spans"), F.length(text).alias("n")), body)


def _running_reach(spans: Column) -> Column:
    """For each span the greatest end of those before it (0 for the first), block by block."""
    none = F.array().cast("array<int>")
    top = lambda part, first: F.aggregate(part, first, lambda m, s: F.greatest(m, s["end"]))
    push = lambda s, end: F.struct(F.greatest(s["m"], end).alias("m"), F.concat(s["out"], F.array(s["m"])).alias("out"))
    start = lambda m: F.struct(m.alias("m"), none.alias("out"))

    def run(v: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / BLOCK).cast("int") - 1), lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK)))
        tops = F.transform(cut, lambda part: top(part, F.lit(0)))
        firsts = F.aggregate(tops, start(F.lit(0)), push, lambda s: s["out"])
        return F.flatten(F.zip_with(cut, firsts, lambda part, m: F.aggregate(part, start(m), lambda s, x: push(s, x["end"]), lambda s: s["out"])))

    return _let(spans, run)


def redact(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """docs with every span of the text replaced by its kind in angle brackets; other columns as they are, whatever their names.

    Overlapping spans are replaced once, under the kind of the first. Null texts stay null.
    """
    spans = found.where(F.size("spans") > 0).select(F.struct(F.col(key).alias("key"), "text_hash", "spans").alias("found")).dropDuplicates(["found"])
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(key).alias("key"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"))
    joined = rows.join(spans, rows["key"].eqNullSafe(F.col("found.key")) & (rows["text_hash"] == F.col("found.text_hash")), "left")
    text = F.when(F.col("found").isNull(), F.col("doc.text")).otherwise(_replaced(F.col("doc.text"), F.col("found.spans")))
    return joined.select(*[text.alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns])
