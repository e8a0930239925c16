"""Rendering examples as chat text, shaping records and responses, parsing model output back (ST16-ST25, ST28-ST30, SK10, CD12, CD13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariffspark.functions import codes, text

#: Texts and tokens of the chat format.
THINK = "<think>\n</think>\n\n"
ABSTAIN = {
    "vague_description": "Cannot classify: The product description is too vague or generic to determine a specific tariff classification. A more detailed description of the product's composition, function, and intended use is needed.",
    "missing_materials": "Cannot classify: The product's material composition is not specified. HTS classification often depends on the primary material (e.g., steel, plastic, textile fiber). Please provide material details.",
    "ambiguous_use": "Cannot classify: The product's intended use or function is unclear. Many tariff headings distinguish products by their application. Please clarify the product's primary use.",
}
ABSTAINED = "__ABSTAIN__"
SYSTEM = (
    "detailed thinking off\n\nYou are an expert in Harmonized Tariff Schedule (HTS) classification. Given a product description, classify it to the correct HTS code by identifying the full tariff hierarchy.\n\n"
    "For each product, provide:\n1. The chapter (2-digit), heading (4-digit), subheading (6-digit), and full HTS code (8-digit)\n2. A brief reasoning explaining why this classification applies\n"
    '3. The "provides for" text from the tariff schedule\n\nIf the description is too vague, lacks critical details, or is ambiguous, respond with "Cannot classify" and explain what information is missing.'
)
_NEXT_SECTION = r"(?dm)^(?:Chapter [0-9]|Heading [0-9.]+|Subheading [0-9.]+|HTS Code:|Reasoning:|Provides for:|Cannot classify:)"


def user_prompt(variant: Column, description: Column, materials: Column, use: Column, country: Column, terms: Column | None = None) -> Column:
    """ST20: rich names the product and what else there is; minimal the product alone; materials_only what else there is, the product
    only if nothing is; glossary_enriched the product and its terms (array of struct term, definition). An unknown variant is rich."""
    line = lambda name, c: F.when(text.present(c), F.concat(F.lit(f"{name}: "), c))
    product = F.concat(F.lit("Product: "), F.coalesce(description, F.lit("")))
    details = [line("Materials", materials), line("Use", use), line("Country of origin", country)]
    alone = F.concat_ws("\n", *details)
    with_terms = product
    if terms is not None:
        listed = F.array_join(F.transform(terms, lambda t: F.concat(F.lit("- "), t["term"], F.lit(": "), F.coalesce(t["definition"], F.lit("")))), "\n")
        with_terms = F.when(F.coalesce(F.size(terms), F.lit(0)) > 0, F.concat(product, F.lit("\n\nRelevant trade terms:\n"), listed)).otherwise(product)
    return F.when(variant == "minimal", product).when(variant == "materials_only", F.when(alone != "", alone).otherwise(product)).when(variant == "glossary_enriched", with_terms).otherwise(F.concat_ws("\n", product, *details))


def request_variant(materials: Column, use: Column, country: Column) -> Column:
    """ST24: rich if a request has anything beside the product."""
    return F.when(text.present(materials) | text.present(use) | text.present(country), "rich").otherwise("minimal")


def answer(code: Column, chapter: Column, heading: Column, tariff: Column, reasoning: Column, provides: Column) -> Column:
    """ST21: four level lines, reasoning, and what the tariff provides for."""
    n = codes.normalized(code)
    blank = lambda c: F.coalesce(c, F.lit(""))
    level = lambda head, desc: text.stripped(F.concat(*head, F.lit(": "), blank(desc)))
    dotted = codes.dotted(code)
    why = F.when(text.present(reasoning), reasoning).otherwise(F.concat(F.lit("Classified under "), dotted, F.lit(" based on product description.")))
    for_text = F.when(text.present(provides), provides).otherwise(blank(tariff))
    lines = F.concat_ws(
        "\n", level([F.lit("Chapter "), F.substring(n, 1, 2)], chapter), level([F.lit("Heading "), F.substring(n, 1, 2), F.lit("."), F.substring(n, 3, 2)], heading),
        level([F.lit("Subheading "), F.substring(n, 1, 4), F.lit("."), F.substring(n, 5, 2)], tariff), F.concat(F.lit("HTS Code: "), dotted),
        F.concat(F.lit("\nReasoning: "), why), F.when(for_text != "", F.concat(F.lit("\nProvides for: "), for_text)),
    )
    return F.concat(F.lit(THINK), lines)


def abstention(category: Column) -> Column:
    """ST22: the vague text is the default."""
    out = F.lit(ABSTAIN["vague_description"])
    for name, words in ABSTAIN.items():
        out = F.when(category == name, F.lit(words)).otherwise(out)
    return F.concat(F.lit(THINK), out)


def messages(system: Column, user: Column, assistant: Column) -> Column:
    """ST23."""
    say = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(say("system", system), say("user", user), say("assistant", assistant))


def example(row: Column, glossary: Column | None = None) -> Column:
    """ST23: the three messages of a training example (struct with the example's fields); abstentions ask with the product alone."""
    variant = F.when(row["abstain"], "minimal").otherwise(row["input_variant"])
    user = user_prompt(variant, row["description"], row["materials"], row["product_use"], row["country"], glossary)
    said = answer(row["hts_code"], row["chapter_description"], row["heading_description"], row["tariff_description"], row["reasoning"], row["hts_text"])
    return messages(F.lit(SYSTEM), user, F.when(row["abstain"], abstention(row["abstain_category"])).otherwise(said))


def request(chat: Column, variant: Column, input_variant: Column, description: Column, materials: Column, use: Column, country: Column, terms: Column | None = None) -> Column:
    """ST25: the first two of a record's own messages, else system and user built from its fields; `variant` goes before `input_variant`."""
    built = F.slice(messages(F.lit(SYSTEM), user_prompt(F.coalesce(variant, input_variant, F.lit("rich")), description, materials, use, country, terms), F.lit("")), 1, 2)
    return F.when(F.coalesce(F.size(chat), F.lit(0)) > 0, F.slice(chat, 1, 2)).otherwise(built)


def adapted(expected: Column) -> Column:
    """ST28: struct(hts_code, abstain) of an expected code in which a sentinel stands for an abstention."""
    none = expected == ABSTAINED
    return F.struct(F.when(none, "").otherwise(expected).alias("hts_code"), F.coalesce(none, F.lit(False)).alias("abstain"))


def expected_body(said: Column) -> Column:
    """ST29: what follows the closing think tag and its blank line; the whole text if there is none."""
    return F.substring_index(said, "</think>\n\n", -1)


def response(p: Column, raw: Column) -> Column:
    """ST30: the nested answer to a request from a parsed prediction; raw only where parsing failed."""
    level = lambda name: F.when(text.present(p[f"{name}_code"]), F.struct(p[f"{name}_code"].alias("code"), p[f"{name}_desc"].alias("description"))).alias(name)
    same = [p[c].alias(c) for c in ("reasoning", "provides_for", "is_abstention", "abstention_reason", "parse_ok")]
    return F.struct(p["hts_code"].alias("hts_code"), level("chapter"), level("heading"), level("subheading"), *same, F.when(~p["parse_ok"], raw).alias("raw"))


def rendered(chat: Column) -> Column:
    """SK10: the raw prompt of a list of messages, ending where the assistant starts."""
    say = lambda m: F.concat(F.lit("<|start_header_id|>"), m["role"], F.lit("<|end_header_id|>\n\n"), m["content"], F.lit("<|eot_id|>"))
    return F.concat(F.lit("<|begin_of_text|>"), F.array_join(F.transform(chat, say), ""), F.lit("<|start_header_id|>assistant<|end_header_id|>\n\n" + THINK))


def parsed(raw: Column) -> Column:
    """ST16-ST19, CD12, CD13: struct of levels, code, reasoning, provides_for, abstention and parse_ok.

    Each line is searched once; what is found is shaped in a second step that only sees the pieces.
    """
    at = F.instr(raw, "</think>")
    body = F.when(at > 0, text.stripped(F.substr(raw, at + 8, F.length(raw)))).otherwise(raw)

    def pieces(b: Column) -> Column:
        got = lambda p, k=1: F.nullif(F.regexp_extract(b, p, k), F.lit(""))
        level = lambda name, code: F.regexp_extract(b, rf"(?d){name} ({code}):\s*(.+?)(?:\n|$)", 0)

        def section(prefix: str) -> Column:
            start = F.instr(b, prefix)
            rest = F.substr(b, start + len(prefix), F.length(b))
            return F.when(start > 0, F.nullif(text.stripped(F.get(F.split(rest, _NEXT_SECTION, 2), F.lit(0))), F.lit("")))

        return F.struct(
            level("Chapter", "[0-9]{1,2}").alias("chapter"), level("Heading", "[0-9.]+").alias("heading"), level("Subheading", "[0-9.]+").alias("subheading"), got(r"HTS Code:\s*([0-9.]+)").alias("code"),
            got(r"(?ds)^Cannot classify:\s*(.+)").alias("reason"), section("Reasoning:").alias("why"), section("Provides for:").alias("provides"),
        )

    def levels(x: Column) -> Column:
        part = lambda line, k: F.nullif(F.regexp_extract(line, r"(?d)^[A-Za-z]+ ([0-9.]+):\s*(.+?)(?:\n|$)", k), F.lit(""))
        both = lambda name: [part(x[name], 1).alias(name), text.stripped(part(x[name], 2)).alias(f"{name}_desc")]
        return F.struct(*both("chapter"), *both("heading"), *both("subheading"), *[x[c].alias(c) for c in ("code", "reason", "why", "provides")])

    def filled(x: Column) -> Column:
        sub = codes.backfilled(x["chapter"], codes.canonical_level(x["heading"], 2, 4), codes.canonical_level(x["subheading"], 4, 6), x["code"])
        return F.struct(sub.alias("codes"), x.alias("x"))

    def shaped(v: Column) -> Column:
        x = v["x"]
        own = lambda c: F.when(x["reason"].isNull(), c)
        return F.struct(
            *[own(c).alias(f"{name}_{kind}") for name in ("chapter", "heading", "subheading") for kind, c in (("code", v["codes"][f"{name}_code"]), ("desc", x[f"{name}_desc"]))],
            own(x["code"]).alias("hts_code"), own(x["why"]).alias("reasoning"), own(x["provides"]).alias("provides_for"),
            x["reason"].isNotNull().alias("is_abstention"), text.stripped(x["reason"]).alias("abstention_reason"), (x["reason"].isNotNull() | x["code"].isNotNull()).alias("parse_ok"),
        )

    return text.let(body, lambda b: text.let(pieces(b), lambda p: text.let(levels(p), lambda x: text.let(filled(x), shaped))))
