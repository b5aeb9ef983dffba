"""Features of candidate pairs: retrieval context, strings, token sets, records, house numbers, candidate groups.

A pair table has (t, s, score, rank, cos_name, cos_addr, cos_cross); ``sides`` adds both records' fields as t_* and s_*.
Window features partition by t or s, whose candidate lists are short by construction on the t side; the s side only needs
counts, sums, maxima and ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ligatura.functions import similarity as sim
from ligatura.functions.columns import split_words
from ligatura.operators.relational import gather_sides, second_best

RETRIEVAL = (
    "score", "rank", "cos_name", "cos_addr", "cos_cross", "t_best", "t_ncand", "t_best_name", "t_best_addr", "t_best_cross", "t_second", "s_ncand", "s_rank", "s_best",
    "s_ntop1", "gap_best", "gap_second", "gap_name", "gap_addr", "gap_cross", "s_gap_best",
)
STRINGS = (
    "nm_ratio", "nm_core_ratio", "nm_tsort", "nm_tset", "nm_partial", "nm_jw", "nm_part_max", "nm_part_min", "cmp_ratio", "cmp_jw", "dom_prefix", "dom_full",
    "ad_ratio", "ad_tsort", "ad_tset", "ad_partial", "street_ratio", "street_tset",
)
SETS = (
    "t_ntok", "s_ntok", "t_natok", "s_natok", "t_nnum", "s_nnum", "nm_common", "ad_common", "num_common", "num_first_eq", "nm_jacc", "ad_jacc", "num_frac",
    "nm_cov_s", "nm_cov_t", "nm_first_ratio",
)
RECORDS = ("f_t_src", "t_indic", "t_alias", "t_domain", "t_noaddr", "s_noaddr", "t_noname", "t_nlen", "s_nlen", "s_addr_mult", "s_street_mult")
NUMBERS = ("hn_rel", "hn_logdiff", "hn_reldiff", "hn_s_in_t", "hn_t_in_s", "hn_lendiff", "nm_xt", "nm_xs")
STREET = ("st_ratio", "st_eq", "lg_t", "lg_s", "lg_common", "lg_conflict")
GROUPS = ("t_n_addr_exact", "t_n_namesake")
#: The 82 features of the first stage, in their order.
STAGE_1 = (*RETRIEVAL, *STRINGS, *SETS, *RECORDS, *NUMBERS, *STREET, *GROUPS)
CONTEXT = (
    "c_t_pmax", "c_t_psum", "c_t_prank", "c_s_pmax", "c_s_psum", "c_s_prank", "c_s_n05", "c_s_n", "c_t_gap", "c_t_vs_rest", "c_s_psum_other", "c_s_gap", "c_hn_same_t",
    "c_hn_same_s",
)
STAGE_2 = (*STAGE_1, "p1", *CONTEXT)
#: Groups that an ablation leaves out one at a time.
ABLATION = {"retrieval": RETRIEVAL, "strings": STRINGS, "sets": SETS, "records": RECORDS, "numbers": NUMBERS, "street_legal": STREET, "groups": GROUPS}


def context_features(c: DataFrame) -> DataFrame:
    """Where each pair stands among the candidates of its query and of its entity."""
    t, s = Window.partitionBy("t"), Window.partitionBy("s")
    nine = F.round("score", 9)
    c = c.withColumns({
        "t_best": F.max("score").over(t), "t_ncand": F.count("*").over(t), "t_best_name": F.max("cos_name").over(t), "t_best_addr": F.max("cos_addr").over(t),
        "t_best_cross": F.max("cos_cross").over(t), "t_second": second_best("score", ["t"]), "s_ncand": F.count("*").over(s),
        "s_rank": F.row_number().over(s.orderBy(nine.desc(), F.asc("t"))), "s_best": F.max("score").over(s), "s_ntop1": F.sum((F.col("rank") == 0).cast("long")).over(s),
    })
    return c.withColumns({
        "gap_best": F.col("t_best") - F.col("score"), "gap_second": F.col("score") - F.coalesce("t_second", F.lit(0.0)), "gap_name": F.col("t_best_name") - F.col("cos_name"),
        "gap_addr": F.col("t_best_addr") - F.col("cos_addr"), "gap_cross": F.col("t_best_cross") - F.col("cos_cross"), "s_gap_best": F.col("s_best") - F.col("score"),
    })


def address_crowding(records: DataFrame) -> DataFrame:
    """``records`` with a_mult and a_smult: entities of the country at the same address, and on the same street; 0 off the entity side."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    place = F.array_join(F.array_sort(F.array_except(split_words("a_key"), split_words("a_street"))), " ")
    street = F.concat_ws("|", text("country"), text("a_street"), place)
    house = F.concat_ws("|", text("country"), text("a_hn"), text("a_street"), place)
    ok = (F.col("src") == 1) & (text("a_hn") != "") & (text("a_street") != "")
    out = records.withColumns({"_ka": house, "_ks": street})
    for key, name in (("_ka", "a_mult"), ("_ks", "a_smult")):
        counts = out.where("src = 1").groupBy(key).agg(F.count("*").alias("_n"))
        out = out.join(counts, key, "left").withColumn(name, F.when(ok, F.col("_n")).otherwise(0)).drop("_n")
    return out.drop("_ka", "_ks")


def sides(pairs: DataFrame, records: DataFrame) -> DataFrame:
    return gather_sides(pairs, records, "entity_id")


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _first(c: str, sep: str) -> Column:
    return F.coalesce(F.get(F.split(_text(c), sep), F.lit(0)), F.lit(""))


def _last(c: str, sep: str) -> Column:
    return F.element_at(F.split(_text(c), sep), -1)


def _numbered(c: str) -> Column:
    return F.coalesce(F.get(F.filter(F.split(_text(c), ","), lambda x: x.rlike("[0-9]")), F.lit(0)), F.lit(""))


def string_features(df: DataFrame) -> DataFrame:
    df = df.withColumns({
        "_tc": _first("t_n_compact", r"\|"), "_sc": _first("s_n_compact", r"\|"), "_sf": _last("s_n_compact", r"\|"), "_td": _first("t_n_domain", r"\|"),
        "_p0": _first("t_n_parts", r"\|"), "_p1": _last("t_n_parts", r"\|"), "_ts": _numbered("t_a_comp"), "_ss": _numbered("s_a_comp"),
    })
    df = df.withColumns({"_sc_head": F.substring(F.col("_sc"), F.lit(1), F.length("_td")), "_sf_head": F.substring(F.col("_sf"), F.lit(1), F.length("_td"))})
    core, full, addr = (_text("t_n_core"), _text("s_n_core")), (_text("t_n_full"), _text("s_n_full")), (_text("t_a_norm"), _text("s_a_norm"))
    scored = df.withColumns({
        "nm_ratio": sim.ratio(*full), "nm_core_ratio": sim.ratio(*core), "nm_tsort": sim.token_sort_ratio(*core), "nm_tset": sim.token_set_ratio(*core),
        "nm_partial": sim.partial_ratio_column(*core), "nm_jw": sim.jaro_winkler(*core), "_a0": sim.token_set_ratio("_p0", core[1]), "_a1": sim.token_set_ratio("_p1", core[1]),
        "cmp_ratio": sim.ratio("_tc", "_sc"), "cmp_jw": sim.jaro_winkler("_tc", "_sc"), "_d0": sim.ratio("_td", "_sc_head"), "_d1": sim.ratio("_td", "_sf_head"),
        "_d2": sim.ratio("_td", "_sc"), "_d3": sim.ratio("_td", "_sf"), "ad_ratio": sim.ratio(*addr), "ad_tsort": sim.token_sort_ratio(*addr), "ad_tset": sim.token_set_ratio(*addr),
        "ad_partial": sim.partial_ratio_column(*addr), "street_ratio": sim.ratio("_ts", "_ss"), "street_tset": sim.token_set_ratio("_ts", "_ss"),
    })
    domain = F.col("_td") != ""
    out = scored.withColumns({
        "nm_part_max": F.greatest("_a0", "_a1"), "nm_part_min": F.least("_a0", "_a1"),
        "dom_prefix": F.when(domain, F.greatest("_d0", "_d1")).otherwise(-1.0), "dom_full": F.when(domain, F.greatest("_d2", "_d3")).otherwise(-1.0),
    })
    return out.drop(*(c for c in out.columns if c.startswith("_")))


def set_features(df: DataFrame) -> DataFrame:
    df = df.withColumns({f"_{side}{tag}": split_words(f"{side}_{c}") for side in "ts" for tag, c in (("n", "n_core"), ("a", "a_norm"), ("u", "a_num"))})
    n = lambda c: F.size(c)
    df = df.withColumns({
        "t_ntok": n("_tn"), "s_ntok": n("_sn"), "t_natok": n("_ta"), "s_natok": n("_sa"), "t_nnum": n("_tu"), "s_nnum": n("_su"),
        "nm_common": n(F.array_intersect("_tn", "_sn")), "ad_common": n(F.array_intersect("_ta", "_sa")), "num_common": n(F.array_intersect("_tu", "_su")),
        "num_first_eq": F.coalesce((F.get("_tu", F.lit(0)) == F.get("_su", F.lit(0))).cast("int"), F.lit(-1)),
    })
    one = lambda c: F.greatest(c, F.lit(1))
    union = lambda a, b, both: one(F.col(a) + F.col(b) - F.col(both))
    out = df.withColumns({
        "nm_jacc": F.col("nm_common") / union("t_ntok", "s_ntok", "nm_common"), "ad_jacc": F.col("ad_common") / union("t_natok", "s_natok", "ad_common"),
        "num_frac": F.col("num_common") / one(F.greatest("t_nnum", "s_nnum")), "nm_cov_s": F.col("nm_common") / one(F.col("s_ntok")), "nm_cov_t": F.col("nm_common") / one(F.col("t_ntok")),
        "nm_first_ratio": sim.ratio(F.coalesce(F.get("_tn", F.lit(0)), F.lit("")), F.coalesce(F.get("_sn", F.lit(0)), F.lit(""))),
    })
    return out.drop(*(c for c in out.columns if c.startswith("_")))


def record_features(df: DataFrame) -> DataFrame:
    flag = lambda c: c.cast("int")
    return df.withColumns({
        "f_t_src": flag(F.col("t_src")), "t_indic": flag(F.col("t_f_indic")), "t_alias": flag(F.col("t_f_alias")), "t_domain": flag(_text("t_n_domain") != ""),
        "t_noaddr": flag(_text("t_a_norm") == ""), "s_noaddr": flag(_text("s_a_norm") == ""), "t_noname": flag(_text("t_n_core") == ""), "t_nlen": F.length(_text("t_n_full")),
        "s_nlen": F.length(_text("s_n_full")), "s_addr_mult": F.col("s_a_mult"), "s_street_mult": F.col("s_a_smult"),
    })


def number_features(df: DataFrame) -> DataFrame:
    a, b = _text("t_a_hn"), _text("s_a_hn")
    both = (a != "") & (b != "")
    x, y = F.substring(a, 1, 9).try_cast("long"), F.substring(b, 1, 9).try_cast("long")
    off = F.abs(x - y)
    inside = lambda h, nums: F.when((h != "") & (F.size(split_words(nums)) > 0), F.array_contains(split_words(nums), h).cast("int")).otherwise(-1)
    return df.withColumns({
        "hn_rel": sim.house_number_relation(a, b), "hn_logdiff": F.when(both, F.log1p(off.cast("double"))).otherwise(-1.0), "hn_reldiff": F.when(both, off / F.greatest(x, y, F.lit(1))).otherwise(-1.0),
        "hn_s_in_t": inside(b, "t_a_num"), "hn_t_in_s": inside(a, "s_a_num"), "hn_lendiff": F.when(both, F.length(a) - F.length(b)).otherwise(-99),
        "nm_xt": sim.tokens_unmatched(_text("t_n_core"), _text("s_n_core")), "nm_xs": sim.tokens_unmatched(_text("s_n_core"), _text("t_n_core")),
    })


def street_features(df: DataFrame) -> DataFrame:
    a, b = _text("t_a_street"), _text("s_a_street")
    lt, ls = split_words("t_n_legal"), split_words("s_n_legal")
    df = df.withColumns({
        "st_ratio": sim.ratio(a, b), "st_eq": F.when((a != "") & (a == b), 1.0).when((a != "") & (b != ""), 0.0).otherwise(-1.0),
        "lg_t": F.size(lt), "lg_s": F.size(ls), "lg_common": F.size(F.array_intersect(lt, ls)),
    })
    return df.withColumn("lg_conflict", ((F.col("lg_t") > 0) & (F.col("lg_s") > 0) & (F.col("lg_common") == 0)).cast("int"))


def group_features(df: DataFrame) -> DataFrame:
    t = Window.partitionBy("t")
    count = lambda c: F.sum(c.cast("long")).over(t)
    return df.withColumns({
        "t_n_addr_exact": count((F.col("hn_rel") == 0) & (F.col("st_eq") == 1)), "t_n_namesake": count((F.col("nm_xt") == 0) & (F.col("nm_xs") == 0)),
    })


def features(pairs: DataFrame, records: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """(t, s, label, the 82 features) of every candidate pair; t_second is -1 where there is none."""
    if truth is not None:  # while rows are short
        pairs = pairs.join(truth.select("t", "s").distinct().withColumn("label", F.lit(1)), ["t", "s"], "left").withColumn("label", F.coalesce("label", F.lit(0)))
    df = context_features(pairs)
    df = sides(df, address_crowding(records))
    for step in (string_features, set_features, record_features, number_features, street_features, group_features):
        df = step(df)
    keep = ["t", "s", *(["label"] if truth is not None else [])]
    return df.select(*keep, *(F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in STAGE_1))


def stage2_context(pairs: DataFrame) -> DataFrame:
    """The 14 context features from first-stage scores: pairs (t, s, p1, t_hn, s_hn)."""
    t, s = Window.partitionBy("t"), Window.partitionBy("s")
    p, six = F.col("p1"), F.round("p1", 9)
    df = pairs.withColumns({
        "c_t_pmax": F.max(p).over(t), "c_t_psum": F.sum(p).over(t), "c_t_prank": F.row_number().over(t.orderBy(six.desc(), F.asc("s"))), "c_s_pmax": F.max(p).over(s),
        "c_s_psum": F.sum(p).over(s), "c_s_prank": F.row_number().over(s.orderBy(six.desc(), F.asc("t"))), "c_s_n05": F.sum((p > 0.5).cast("long")).over(s), "c_s_n": F.count("*").over(s),
    })
    strong = ((p >= 0.5) & (F.col("t_hn") != "")).cast("long")
    agree = strong * (F.col("t_hn") == F.col("s_hn")).cast("long")
    return df.withColumns({
        "c_t_gap": F.col("c_t_pmax") - p, "c_t_vs_rest": 2 * p - F.col("c_t_psum"), "c_s_psum_other": F.col("c_s_psum") - p, "c_s_gap": F.col("c_s_pmax") - p,
        "c_hn_same_t": F.when(F.col("t_hn") == "", -1).otherwise(F.sum(strong).over(Window.partitionBy("s", "t_hn")) - strong),
        "c_hn_same_s": F.when(F.col("s_hn") == "", -1).otherwise(F.sum(agree).over(s) - agree),
    })
