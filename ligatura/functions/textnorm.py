"""Normalisation of business names and addresses, as native column expressions.

``normalize`` turns raw name, address and country into one struct of normalised fields and blocking features. Nothing
here needs a Python worker: accents are folded with ``translate``, token lists are folded with higher-order functions,
and the one fuzzy test (a parenthesised country name with a misread letter) uses the native indel ratio.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ligatura.functions import tables as T
from ligatura.functions.columns import Value, among, col, joined, let, lookup, non_empty, split_words, strings
from ligatura.functions.similarity import ratio_native

# ---- fixed values: patterns
INDIC = "[\\u0900-\\u0DFF]"
ZERO_WIDTH = "[\\u200B-\\u200F\\u2060\\uFEFF\\u00AD]"
ID_TAG = r"(?i)\(\s*id\s*:\s*\d+\s*\)"
MESSRS = r"(?i)\bm\s*/\s*s\b\.?"
ALIAS = (
    r"(?i)\s*(?:\||\b(?:d\s*/\s*b\s*/\s*a|a\s*/\s*k\s*/\s*a|f\s*/\s*k\s*/\s*a|t\s*/\s*a)\b\.?"
    r"|\b(?:dba|formerly|aka|fka|also known as|trading as)\b\s*:?)\s*"
)
NULL_WORDS = r"(?i)<\s*null\s*>|\bnull\b|\bn\s*/\s*a\b|\bnone\b|\bc\s*/\s*o\b\.?"
PO_BOX = r"(?i)\b(?:p\.?\s*o\.?\s*box|post\s*box|bp|cs)\s*[.:#]?\s*\d+\b|\bcedex(?:\s*\d+)?\b"
NUMBER_SIGN = "(?i)\\bn\\s*[\\u00B0\\u00BA]"
DOMAIN = r"^(?:https?://)?(?:www\.)?([a-z0-9][a-z0-9\-]*)\.(?:" + "|".join(e.replace(".", r"\.") for e in T.DOMAIN_ENDS) + ")$"
DOMAIN_EDGE = r"""^[.,;:()\[\]{}<>*#\-_"']+|[.,;:()\[\]{}<>*#\-_"']+$"""
# ---- fixed values end


def _folding() -> tuple[str, str, str]:
    """(characters, their plain forms, combining marks) of the basic plane, from their compatibility decompositions."""
    accented, plain, marks = [], [], []
    for c in range(0x80, 0xFFFF):
        ch = chr(c)
        if 0xD800 <= c < 0xE000 or 0x3400 <= c < 0xA000 or 0xAC00 <= c < 0xD7A4:
            continue
        if unicodedata.combining(ch):
            marks.append(ch)
            continue
        base = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if base != ch and len(base) == 1:
            accented.append(ch)
            plain.append(base)
    return "".join(accented), "".join(plain), "".join(marks)


_ACCENTED, _PLAIN, _MARKS = _folding()


def to_ascii(s: Value) -> Column:
    """Lower case without zero-width characters, accents and combining marks."""
    clean = F.regexp_replace(col(s), ZERO_WIDTH, "")
    return F.lower(F.translate(F.translate(clean, _ACCENTED, _PLAIN), _MARKS, ""))


@F.pandas_udf(StringType())
def to_ascii_exact(s: pd.Series) -> pd.Series:
    """``to_ascii`` also for characters whose decomposition has several characters (ligatures, fractions)."""
    zero = {c: None for c in (*range(0x200B, 0x2010), 0x2060, 0xFEFF, 0xAD)}
    fold = lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFKD", x.translate(zero)) if not unicodedata.combining(c)).lower()
    return s.map(fold)


def latin_tokens(s: Value) -> Column:
    return non_empty(F.split(col(s), "[^a-z0-9]+"))


def is_indic(s: Value) -> Column:
    return F.coalesce(col(s).rlike(INDIC), F.lit(False))


def indic_key(s: Value) -> Column:
    """Lookup key of an Indic word: letters, digits and marks alone."""
    return F.regexp_replace(F.regexp_replace(col(s), ZERO_WIDTH, ""), r"[^\p{L}\p{N}\p{M}]", "")


def transliterate_words(s: Value, lexicon: Column) -> Column:
    """Indic words by their lexicon entry (``lexicon`` is a map column), else folded to ASCII; other words as they are."""
    words = non_empty(F.split(col(s), r"\s+"))
    return joined(F.transform(words, lambda w: F.when(w.rlike(INDIC), F.coalesce(F.try_element_at(lexicon, indic_key(w)), to_ascii(w))).otherwise(w)))


def transliterate_component(s: Value, lexicon: Column) -> Column:
    return F.when(col(s).rlike(INDIC), F.coalesce(F.try_element_at(lexicon, indic_key(s)), to_ascii(s))).otherwise(col(s))


# ------------------------------------------------------------------------ names


def alias_parts(name: Value) -> Column:
    """The alternative names that one field holds; one empty part if there is none."""
    clean = F.regexp_replace(F.regexp_replace(F.coalesce(col(name), F.lit("")), ID_TAG, " "), MESSRS, " ")
    return let(F.filter(F.split(clean, ALIAS), lambda p: F.trim(p) != ""), lambda p: F.when(F.size(p) > 0, p).otherwise(strings("")))


def country_tokens(country: Value) -> Column:
    return latin_tokens(to_ascii(F.coalesce(col(country), F.lit(""))))


def is_country_tag(text: Column, country: Column) -> Column:
    """Whether a parenthesised text is the record's own country, also with a misread letter (ratio of 80 or more)."""
    name = joined(country, "")
    near = lambda t: (t != "") & ((t == name) | ((F.length(t) >= 3) & (F.abs(F.length(t) - F.length(name)) <= 5) & (ratio_native(t, name) >= 80)))
    return (F.size(country) > 0) & let(joined(latin_tokens(text), ""), near)


def drop_country_tags(s: Column, country: Column) -> Column:
    chunks = F.regexp_extract_all(s, F.lit(r"\(([^()]*)\)"), F.lit(1))
    tags = F.filter(chunks, lambda c: is_country_tag(c, country))
    return F.aggregate(tags, s, lambda acc, c: F.replace(acc, F.concat(F.lit("("), c, F.lit(")")), F.lit(" ")))


def merge_initials(tokens: Column) -> Column:
    """Runs of two or more single letters become one token, an ``&`` inside a run being dropped."""
    empty = strings()
    flush = lambda acc: F.when(F.size(acc["run"]) >= 2, F.concat(acc["out"], F.array(joined(acc["run"], "")))).otherwise(F.concat(acc["out"], acc["run"]))

    def step(acc: Column, t: Column) -> Column:
        letter = (F.length(t) == 1) & (t != "&")
        glue = (t == "&") & (F.size(acc["run"]) > 0)
        return (
            F.when(letter, F.struct(acc["out"].alias("out"), F.concat(acc["run"], F.array(t)).alias("run")))
            .when(glue, F.struct(acc["out"].alias("out"), acc["run"].alias("run")))
            .otherwise(F.struct(F.concat(flush(acc), F.array(t)).alias("out"), empty.alias("run")))
        )

    return F.aggregate(tokens, F.struct(empty.alias("out"), empty.alias("run")), step, flush)


def legal_flags(tokens: Column) -> Column:
    """For each token, whether it is a legal form: strict ones anywhere, weak ones only in the position of one."""

    def flag(t: Column, i: Column) -> Column:
        before, after = F.get(tokens, i - 1), F.get(tokens, i + 1)
        rest = F.slice(tokens, i + 2, F.size(tokens))
        trailing = F.forall(rest, lambda x: among(x, T.LEGAL + T.NAME_STOP))
        beside = F.coalesce((before == "&") | among(before, T.LEGAL), F.lit(False)) | F.coalesce(among(after, T.LEGAL), F.lit(False))
        return among(t, T.STRICT_LEGAL) | (among(t, T.WEAK_LEGAL) & (trailing | beside))

    return F.transform(tokens, flag)


def drop_trailing_country(tokens: Column, country: Column) -> Column:
    k = F.size(country)
    rest = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - k, F.lit(0)))
    content = F.size(F.filter(rest, lambda t: ~among(t, T.NAME_STOP)))
    tail = F.slice(tokens, F.greatest(F.size(tokens) - k + 1, F.lit(1)), F.greatest(k, F.lit(0)))
    return F.when((k > 0) & (F.size(tokens) >= k + T.MIN_CORE_COUNTRY) & (tail == country) & (content >= T.MIN_CORE_COUNTRY), rest).otherwise(tokens)


def core_tokens(tokens: Column) -> Column:
    """Without stop words if two tokens stay, else only without ``&``; each token once."""
    content = F.filter(tokens, lambda t: ~among(t, T.NAME_STOP))
    return F.array_distinct(let(content, lambda c: F.when(F.size(c) >= T.MIN_CORE, c).otherwise(F.filter(tokens, lambda t: t != "&"))))


def name_part(part: Column, country: Column) -> Column:
    """One alias part as a struct of arrays: full, core, domains, legal."""
    canon = lookup(T.NAME_CANON)
    spaced = F.replace(F.replace(drop_country_tags(to_ascii(part), country), F.lit("&"), F.lit(" & ")), F.lit("+"), F.lit(" & "))
    domain = lambda r: F.regexp_extract(F.regexp_replace(r, DOMAIN_EDGE, ""), DOMAIN, 1)

    def tokens(raw: Column) -> Column:
        own = F.when(raw == "&", strings("&")).otherwise(latin_tokens(F.regexp_replace(raw, "[.'\\u2019]", "")))
        return F.flatten(F.transform(own, lambda t: F.split(F.coalesce(F.try_element_at(canon, t), t), " ")))

    def build(raws: Column) -> Column:
        merged = merge_initials(F.flatten(F.transform(F.filter(raws, lambda r: domain(r) == ""), tokens)))
        domains = F.transform(F.filter(raws, lambda r: domain(r) != ""), lambda r: F.replace(domain(r), F.lit("-"), F.lit("")))

        def fields(toks: Column) -> Column:
            def split_legal(flags: Column) -> Column:
                keep = F.filter(toks, lambda t, i: ~F.get(flags, i))
                legal = F.filter(toks, lambda t, i: F.get(flags, i) & (t != "cie"))
                return F.struct(
                    F.filter(toks, lambda t: t != "&").alias("full"), let(drop_trailing_country(keep, country), core_tokens).alias("core"), domains.alias("domains"), legal.alias("legal")
                )

            return let(legal_flags(toks), split_legal)

        return let(merged, fields)

    return let(non_empty(F.split(spaced, r"\s+")), build)


def norm_name(name: Value, country: Value, lexicon: Column | None = None) -> Column:
    """A struct of n_full, n_core, n_parts, n_compact, n_domain, n_legal, f_indic, f_alias."""
    raw = F.coalesce(col(name), F.lit(""))
    said = raw if lexicon is None else F.when(raw.rlike(INDIC), transliterate_words(raw, lexicon)).otherwise(raw)

    def build(parts: Column) -> Column:
        results = let(country_tokens(country), lambda ct: F.transform(parts, lambda p: name_part(p, ct)))

        def fields(all_parts: Column) -> Column:
            some = F.filter(all_parts, lambda r: (F.size(r["full"]) > 0) | (F.size(r["core"]) > 0))
            compact = F.flatten(F.transform(some, lambda r: F.array(joined(r["core"], ""), joined(r["full"], ""))))
            domains = F.flatten(F.transform(all_parts, lambda r: r["domains"]))
            return F.struct(
                joined(F.transform(some, lambda r: joined(r["full"]))).alias("n_full"),
                joined(F.array_distinct(F.flatten(F.transform(some, lambda r: r["core"])))).alias("n_core"),
                joined(non_empty(F.transform(some, lambda r: joined(r["core"]))), "|").alias("n_parts"),
                joined(F.array_distinct(non_empty(F.concat(compact, domains))), "|").alias("n_compact"),
                joined(domains, "|").alias("n_domain"),
                joined(F.array_sort(F.array_distinct(F.flatten(F.transform(all_parts, lambda r: r["legal"]))))).alias("n_legal"),
                is_indic(raw).alias("f_indic"),
                (F.size(parts) > 1).alias("f_alias"),
            )

        return let(results, fields)

    return let(alias_parts(said), build)


# -------------------------------------------------------------------- addresses


def address_component(component: Column, france: Column) -> Column:
    """The canonical tokens of one comma-separated component; the name of a state alone becomes its code."""
    canon, french, admin = lookup(T.ADDR_CANON), lookup(T.ADDR_CANON | T.ADDR_CANON_FRANCE), lookup(T.admin_codes())
    plain = F.regexp_replace(F.replace(to_ascii(component), F.lit("&"), F.lit(" and ")), "['\\u2019]", " ")

    def one(t: Column) -> Column:
        number = F.when(t.rlike("^[0-9]+$"), F.regexp_replace(t, "^0+(?=.)", "")).otherwise(t)
        return let(number, lambda v: F.coalesce(F.when(france, F.try_element_at(french, v)).otherwise(F.try_element_at(canon, v)), v))

    def build(toks: Column) -> Column:
        out = F.filter(F.transform(toks, one), lambda t: ~(among(t, T.ADDR_STOP) & (F.size(toks) > 1)))
        return let(F.try_element_at(admin, joined(toks)), lambda state: F.when(state.isNotNull(), F.array(state)).otherwise(out))

    return let(latin_tokens(plain), build)


def norm_address(address: Value, country: Value, lexicon: Column | None = None) -> Column:
    """A struct of a_norm, a_comp, a_num, a_hn, a_street, a_key."""
    raw = F.coalesce(col(address), F.lit(""))
    for pattern in (NULL_WORDS, PO_BOX, NUMBER_SIGN):
        raw = F.regexp_replace(raw, pattern, " ")
    france = F.coalesce(among(F.trim(to_ascii(col(country))), T.FRANCE), F.lit(False))
    pieces = F.transform(F.split(raw, ","), lambda p: F.trim(p))  # not F.trim itself: its second parameter would get the index
    if lexicon is not None:
        pieces = F.transform(pieces, lambda p: transliterate_component(p, lexicon))
    digit = lambda t: t.rlike("[0-9]")

    def build(comps: Column) -> Column:
        numbered = F.filter(comps, lambda c: F.exists(c, digit))
        main = F.filter(numbered, lambda c: ~among(F.element_at(c, 1), T.UNIT_WORDS))
        street = F.coalesce(F.get(main, F.lit(0)), F.get(numbered, F.lit(0)), strings())
        # the street line is the first component equal to it; the others follow for the key words
        place = F.coalesce(F.array_position(comps, street), F.lit(0))

        def fields(line: Column) -> Column:
            words = F.filter(line, lambda t: ~digit(t))
            others = F.flatten(F.filter(comps, lambda c, i: i + 1 != place))
            distinctive = lambda t: (F.length(t) >= 3) & ~among(t, T.ADDR_GENERIC) & ~among(t, T.state_codes()) & ~digit(t)
            flat = joined(F.flatten(comps))
            return F.struct(
                flat.alias("a_norm"), joined(F.transform(comps, lambda c: joined(c)), ",").alias("a_comp"),
                joined(F.array_distinct(F.regexp_extract_all(flat, F.lit("([0-9]+)"), F.lit(1)))).alias("a_num"),
                F.regexp_extract(F.coalesce(F.get(F.filter(line, digit), F.lit(0)), F.lit("")), "[0-9]+", 0).alias("a_hn"),
                joined(words).alias("a_street"), joined(F.slice(F.array_distinct(F.filter(F.concat(words, others), distinctive)), 1, T.KEY_WORDS)).alias("a_key"),
            )

        return let(street, fields)

    return let(F.filter(F.transform(pieces, lambda p: address_component(p, france)), lambda c: F.size(c) > 0), build)


# --------------------------------------------------------------------- features


def blocking_features(n: Column, a: Column) -> Column:
    """A struct of feat_name, feat_addr, feat_cross: arrays of distinct feature strings.

    ``n:`` core token, ``p:`` unordered token pair of an alias part, ``k:`` head of a compact name; ``a:`` address token,
    ``b:`` neighbouring tokens of a component, ``h:`` house number and key word; ``c:`` name token and key word.
    """
    tagged = lambda tag: lambda t: F.concat(F.lit(tag), t)

    def pairs(toks: Column) -> Column:
        head = F.slice(toks, 1, 6)
        two = F.transform(head, lambda x, i: F.transform(F.slice(head, i + 2, F.lit(6)), lambda y: F.concat(F.lit("p:"), F.least(x, y), F.lit("_"), F.greatest(x, y))))
        return F.flatten(two)

    def bigrams(toks: Column) -> Column:
        return F.transform(F.slice(toks, 2, 10_000), lambda y, i: F.concat(F.lit("b:"), F.get(toks, i), F.lit("_"), y))

    parts = F.transform(split_words(n["n_parts"], r"\|"), lambda p: split_words(p))
    comps = F.transform(split_words(a["a_comp"], ","), lambda c: split_words(c))
    heads = F.transform(F.filter(split_words(n["n_compact"], r"\|"), lambda c: F.length(c) >= 5), lambda c: F.concat(F.lit("k:"), F.substring(c, 1, 8)))
    keys = F.slice(split_words(a["a_key"]), 1, 5)
    named = F.concat(F.flatten(F.transform(parts, lambda p: F.concat(F.transform(p, tagged("n:")), pairs(p)))), heads)
    placed = F.flatten(F.transform(comps, lambda c: F.concat(F.transform(c, tagged("a:")), bigrams(c))))
    housed = F.when(a["a_hn"] != "", F.transform(keys, lambda k: F.concat(F.lit("h:"), a["a_hn"], F.lit("_"), k))).otherwise(strings())
    cross = F.flatten(F.transform(F.slice(split_words(n["n_core"]), 1, 3), lambda t: F.transform(keys, lambda k: F.concat(F.lit("c:"), t, F.lit("_"), k))))
    return F.struct(F.array_distinct(named).alias("feat_name"), F.array_distinct(F.concat(placed, housed)).alias("feat_addr"), F.array_distinct(cross).alias("feat_cross"))


def normalize(df, name: str, address: str, country: str, lexicons: tuple[Column, Column] | None = None):
    """``df`` with the 17 normalised fields as columns; ``lexicons`` are map columns for names and addresses."""
    name_lexicon, address_lexicon = lexicons or (None, None)
    both = df.withColumns({"_n": norm_name(name, country, name_lexicon), "_a": norm_address(address, country, address_lexicon)})
    return both.withColumn("_f", let(F.struct("_n", "_a"), lambda x: blocking_features(x["_n"], x["_a"]))).select(*df.columns, "_n.*", "_a.*", "_f.*")


def group_key(core: Value, country: Value) -> Column:
    """Namesakes share this: sorted core tokens and the country."""
    return F.concat_ws("|", joined(F.array_sort(split_words(core))), F.coalesce(col(country), F.lit("")))


# --------------------------------------------------------------------- phonetic

#: Rewriting rules of the phonetic skeleton, in order.
SKELETON_RULES = (("tion", "sn"), ("ture", "cr"), ("c(?=[eiy])", "s"), ("x", "ks"), ("ph", "f"), ("sh", "s"), ("([bcdgjkptr])h", "$1"))


def skeleton(token: Value) -> Column:
    """First letter and consonants, like sounds unified; tokens under three letters or not of letters alone are unchanged."""
    low = F.lower(col(token))
    s = low
    for pattern, new in SKELETON_RULES:
        s = F.regexp_replace(s, pattern, new)
    s = F.translate(s, "cqwvzg", "kkbbjj")
    s = F.concat(F.substring(s, 1, 1), F.regexp_replace(F.substring(s, 2, 10_000), "[aeiouy]", ""))
    return F.when((F.length(low) < 3) | ~low.rlike(r"^\p{L}+$"), low).otherwise(F.regexp_replace(s, r"(.)\1+", "$1"))
