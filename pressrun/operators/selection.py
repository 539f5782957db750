"""Eligibility, lanes, topics, related groups and the packing of an edition."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressrun.config import AXES, SelectConfig
from pressrun.functions import text
from pressrun.functions.text import rounded
from pressrun.operators import blocking, similarity
from pressrun.operators.candidates import ranked_tokens
from pressrun.operators.evaluation import complete
from pressrun.operators.graph import components, join_groups, stored
from pressrun.operators.naming import list_digests
from pressrun.operators.similarity import FREQUENT


def axes(prefix: str = "") -> dict[str, Column]:
    return {a: F.col(prefix + a) for a in AXES}


def below_floor(config: SelectConfig = SelectConfig()) -> Column:
    importance, impact, information = config.floor_low
    return (F.col("informationValue") <= config.floor_information) | ((F.col("importance") <= importance) & (F.col("impact") <= impact) & (F.col("informationValue") <= information))


def ineligibility(config: SelectConfig = SelectConfig()) -> Column:
    """Why a cluster is out; null if it is in. status, the five axes."""
    return F.when((F.coalesce(F.col("status"), F.lit("")) != "evaluated") | ~complete(axes()), "not-evaluated").when(below_floor(config), "below-quality-floor")


def with_lanes(records: DataFrame, config: SelectConfig = SelectConfig()) -> DataFrame:
    """Adds eligible, reason, ranks, gates, lanes and lane."""
    full, s = complete(axes()), axes()
    rank = lambda w: F.when(full, rounded(sum((F.lit(v) * s[k] for k, v in list(w.items())[1:]), F.lit(next(iter(w.values()))) * s[next(iter(w))])))
    out = records.withColumn("reason", ineligibility(config)).withColumn("eligible", F.col("reason").isNull())
    out = out.withColumn("major_rank", rank(config.major_weights)).withColumn("personal_rank", rank(config.personal_weights))
    out = out.withColumn("major", F.col("eligible") & full & (s["importance"] >= config.major_gate[0]) & (s["impact"] >= config.major_gate[1]))
    out = out.withColumn("personal", F.col("eligible") & full & (s["personalRelevance"] >= config.personal_gate[0]) & (s["informationValue"] >= config.personal_gate[1]))
    out = out.withColumn("general", F.col("eligible") & F.coalesce(F.col("base_score") >= config.general_min_base, F.lit(False)))
    lanes = F.filter(F.array(F.when(F.col("major"), F.lit("major")), F.when(F.col("personal"), F.lit("personal")), F.when(F.col("general"), F.lit("general"))), lambda x: x.isNotNull())
    return out.withColumn("lanes", lanes).withColumn("lane", F.get("lanes", F.lit(0)))


def with_topic(records: DataFrame, config: SelectConfig = SelectConfig()) -> DataFrame:
    body = F.lower(text.nfkc(F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("summary", F.lit("")))))
    return records.withColumn("haystack", body).withColumn("topic_group", text.topic(F.col("haystack"), F.col("category"), config.priority, config.keywords, config.fallback)).drop("haystack")


def overlap_rows(records: DataFrame) -> DataFrame:
    """What title overlap compares, computed once for each distinct title; id: a short name of the title."""
    titles = records.where("title IS NOT NULL").select("title").distinct().withColumn("id", F.md5(F.col("title").cast("binary")))
    full = titles.withColumn("nfkc", text.nfkc("title")).withColumn("norm", text.normalized_title(F.col("nfkc")))
    full = full.withColumn("terms", text.terms(F.col("nfkc"), F.col("title"))).withColumn("proper", text.proper_nouns(F.col("title")))
    return stored(full.drop("nfkc"))


def long_terms(terms: Column, proper: Column, config: SelectConfig = SelectConfig()) -> Column:
    return F.filter(terms, lambda t: (F.length(t) >= config.overlap_long_term) & (F.array_contains(proper, t) | t.rlike(f"[{text.CJK}]")))


#: The rules of overlap; a pair has the first that holds.
RULES = ("exact-title", "high-dice", "shared-cjk-run", "long-shared-term")


def ruled(pairs: DataFrame, rows: DataFrame, config: SelectConfig = SelectConfig()) -> DataFrame:
    """pairs: id_a, id_b. Adds title_a, title_b and rule: the place in RULES of the first rule that holds; pairs without one are dropped."""
    side = lambda s: rows.select(*[F.col(c).alias(f"{c}_{s}") for c in rows.columns])
    met = pairs.join(side("a"), "id_a").join(side("b"), "id_b")
    terms, proper = F.array_intersect("terms_a", "terms_b"), F.array_intersect("proper_a", "proper_b")
    comparable = F.least(F.length("norm_a"), F.length("norm_b")) >= config.overlap_title_length
    comparable = comparable & F.col("norm_a").isNotNull() & F.col("norm_b").isNotNull() & (F.size(proper) >= config.overlap_proper)
    alike = similarity.text_dice(F.when(comparable, F.col("norm_a")), F.when(comparable, F.col("norm_b")))
    run = text.longest_shared_run(F.least("title_a", "title_b"), F.greatest("title_a", "title_b"))
    rule = (
        F.when(F.col("norm_a") == F.col("norm_b"), 0).when(rounded(alike) >= config.overlap_dice, 1).when(text.distinctive_run(run, config.overlap_cjk_run), 2)
        .when((F.size(long_terms(terms, proper, config)) >= 1) & (F.size(terms) >= config.overlap_terms), 3)
    )
    return met.select("id_a", "id_b", "title_a", "title_b", rule.alias("rule")).where("rule IS NOT NULL")


def detailed(found: DataFrame) -> DataFrame:
    """found: title_a, title_b, rule. title_a < title_b and detail."""
    return found.select(F.least("title_a", "title_b").alias("title_a"), F.greatest("title_a", "title_b").alias("title_b"), F.get(F.array(*[F.lit(r) for r in RULES]), F.col("rule")).alias("detail"))


def overlap(pairs: DataFrame, rows: DataFrame, config: SelectConfig = SelectConfig()) -> DataFrame:
    """pairs: id_a, id_b. title_a < title_b and detail of those that overlap."""
    return detailed(ruled(pairs, rows, config))


#: Titles with a long term up to which all of them are compared; a more frequent term is a key only beside another one.
LONG = 1_000


def alike_pairs(rows: DataFrame, config: SelectConfig = SelectConfig()) -> DataFrame:
    """id_a, id_b: titles of high Dice with nouns in common. Normal forms are compared by sketches and by the nouns of their titles."""
    fine = rows.where((F.length("norm") >= config.overlap_title_length) & (F.size("proper") >= config.overlap_proper)).select("id", "norm", "proper")
    nouns = F.array_distinct(F.flatten(F.collect_list(F.transform("proper", lambda x: F.xxhash64(x)))))
    forms = stored(fine.groupBy("norm").agg(F.min("id").alias("form"), nouns.alias("tags")))
    near = similarity.dice_pairs(forms.select(F.col("form").alias("id"), F.col("norm").alias("t"), "tags"), config.overlap_dice, spread=4, least=config.overlap_proper)
    titles = stored(fine.join(forms.drop("tags"), "norm").select("form", "id", "proper"))
    side = lambda s: titles.select(F.col("form").alias(f"form_{s}"), F.col("id").alias(f"id_{s}"), F.col("proper").alias(f"proper_{s}"))
    met = near.select(F.col("id_a").alias("form_a"), F.col("id_b").alias("form_b")).join(side("a"), "form_a").join(side("b"), "form_b")
    met = met.where(F.size(F.array_intersect("proper_a", "proper_b")) >= config.overlap_proper)
    return met.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))


def long_term_pairs(rows: DataFrame, config: SelectConfig = SelectConfig()) -> DataFrame:
    """id_a, id_b: titles that share a long term and enough terms. Terms go along as numbers and are compared where titles meet, so no
    other pair is listed.

    A long term that two titles share through their nouns is a noun of both. Titles with a frequent one meet by it and one of the rarest
    others, of which titles with enough terms in common share one.
    """
    hashed = lambda c: F.transform(c, lambda x: F.xxhash64(x))
    found = rows.where(F.size("terms") >= config.overlap_terms).select("id", hashed(long_terms(F.col("terms"), F.col("proper"), config)).alias("long"), hashed("terms").alias("terms")).where(F.size("long") > 0)
    each = stored(found.select("id", F.explode("long").alias("k"), "terms"))
    others = config.overlap_terms - 1
    if others >= 1:
        frequent = stored(each.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > LONG).orderBy(F.desc("n"), "k").limit(FREQUENT).select("k"))
        often = stored(each.join(F.broadcast(frequent), "k", "left_semi"))
        ranked = ranked_tokens(often.select(F.col("id").alias("class_id"), "terms").dropDuplicates(["class_id"]), "terms").select(F.col("class_id").alias("id"), F.col("terms").alias("ranked"))
        rest = F.filter("ranked", lambda t: t != F.xxhash64("k"))
        beside = often.join(ranked, "id").select("id", "k", "terms", F.explode(F.slice(rest, F.lit(1), F.greatest(F.size(rest) - others + 1, F.lit(0)))).alias("t"))
        each = stored(each.join(F.broadcast(frequent), "k", "left_anti").select("id", "k", "terms").unionByName(beside.select("id", F.xxhash64("k", "t").alias("k"), "terms")))
    return blocking.pairs(each, ["terms"], F.size(F.array_intersect("terms_x", "terms_y")) >= config.overlap_terms)


def overlapping(rows: DataFrame, config: SelectConfig = SelectConfig()) -> DataFrame:
    """id_a < id_b, rule: names of distinct titles that overlap, and the place in RULES of the first rule that holds; stored. rows: `overlap_rows`.

    Each rule has its own way to its pairs, which lists few others: equal normal forms; sketches; pieces of CJK runs as long as the least
    run, since a shared run lies in a run of the other title; long terms.
    """
    equal = blocking.pairs(stored(rows.where("norm IS NOT NULL").select("id", F.xxhash64("norm").alias("k"))), [], F.lit(True))
    long_runs = F.filter(text.cjk_runs(F.col("title")), lambda r: F.length(r) >= config.overlap_cjk_run)
    pieces = rows.select("id", F.explode(long_runs).alias("run")).select("id", F.explode(text.grams(F.col("run"), config.overlap_cjk_run)).alias("piece")).select("id", F.xxhash64("piece").alias("k")).distinct()
    in_runs = ruled(stored(blocking.pairs(stored(pieces), [], F.lit(True))), rows, config).select("id_a", "id_b", "rule")
    named = lambda pairs, rule: pairs.select("id_a", "id_b", F.lit(rule).alias("rule"))
    every = named(equal, 0).unionByName(named(alike_pairs(rows, config), 1)).unionByName(in_runs).unionByName(named(long_term_pairs(rows, config), 3))
    return stored(every.groupBy("id_a", "id_b").agg(F.min("rule").alias("rule")))


def overlapping_titles(records: DataFrame, config: SelectConfig = SelectConfig()) -> DataFrame:
    """title_a < title_b, detail of distinct titles that overlap."""
    rows = overlap_rows(records)
    side = lambda s: rows.select(F.col("id").alias(f"id_{s}"), F.col("title").alias(f"title_{s}"))
    return detailed(overlapping(rows, config).join(side("a"), "id_a").join(side("b"), "id_b"))


def group_edges(records: DataFrame, judged: DataFrame, config: SelectConfig = SelectConfig()) -> DataFrame:
    """cluster_a, cluster_b, kind, detail: evidence between clusters.

    records: cluster_id, title; judged: cluster_a, cluster_b of related-event judgments. Clusters with one title are
    linked to the least of them, other overlaps link the least clusters of both titles: the same groups as all pairs.
    """
    by_title = records.where("title IS NOT NULL").groupBy("title").agg(F.min("cluster_id").alias("least"))
    same = records.join(by_title, "title").where("cluster_id <> least").select(F.col("least").alias("cluster_a"), F.col("cluster_id").alias("cluster_b"), F.lit("title-overlap").alias("kind"), F.lit("exact-title").alias("detail"))
    rows = overlap_rows(records)
    least = stored(rows.select("id", "title").join(by_title, "title").select("id", "least"))
    linked = overlapping(rows, config).join(least.withColumnsRenamed({"id": "id_a", "least": "x"}), "id_a").join(least.withColumnsRenamed({"id": "id_b", "least": "y"}), "id_b")
    detail = F.get(F.array(*[F.lit(r) for r in RULES]), F.col("rule")).alias("detail")
    other = linked.select(F.least("x", "y").alias("cluster_a"), F.greatest("x", "y").alias("cluster_b"), F.lit("title-overlap").alias("kind"), detail)
    external = judged.where("cluster_a <> cluster_b").select(F.least("cluster_a", "cluster_b").alias("cluster_a"), F.greatest("cluster_a", "cluster_b").alias("cluster_b"), F.lit("semantic-related-event").alias("kind"), F.lit("related-event").alias("detail"))
    return external.unionByName(same).unionByName(other).dropDuplicates(["cluster_a", "cluster_b", "kind", "detail"])


def related_groups(records: DataFrame, judged: DataFrame, config: SelectConfig = SelectConfig()) -> DataFrame:
    """records with related_group_id and editorial_role; ineligible clusters take part. A main event leads its group."""
    edges = group_edges(records, judged, config)
    found = components(records.select(F.col("cluster_id").alias("id")), edges.select(F.col("cluster_a").alias("a"), F.col("cluster_b").alias("b")))
    named = stored(records.join(found.select(F.col("id").alias("cluster_id"), F.col("root").alias("group_root")), "cluster_id"))
    order = F.struct(-F.coalesce("major_rank", F.lit(-1.0)), -F.coalesce("informationValue", F.lit(-1)), F.col("published_ms").isNull(), -F.coalesce("published_ms", F.lit(0)), F.col("cluster_id"))
    leaders = named.groupBy("group_root").agg(F.min_by("cluster_id", order).alias("leader"), F.count("*").alias("n_clusters"))
    ids = list_digests(named.select(F.col("group_root").alias("root"), F.col("cluster_id").alias("id")), "|")
    ids = ids.select(F.col("root").alias("group_root"), F.concat(F.lit("rel:"), F.substring("sha", 1, 16)).alias("related_group_id"))
    led = join_groups(named, stored(leaders.join(ids, "group_root")), "group_root", "n_clusters", named.count())
    return led.withColumn("editorial_role", F.when(F.col("cluster_id") == F.col("leader"), "main-event").otherwise("related")).drop("group_root", "leader", "n_clusters")


PACKED = "cluster_id string, decision string, reason string, lane string, rank int, priority double"


def pack(records: DataFrame, config: SelectConfig = SelectConfig()) -> DataFrame:
    """cluster_id, decision, reason, lane, rank, priority of every record.

    Each lane takes at most `most` clusters and topics saturate, so whoever can be accepted stands among the first
    of its lane and topic: of each (lane, topic) only the first `most` + 1 go to the one task that packs them. All
    others are settled by expressions from the state that task ends with.
    """
    main = F.col("eligible") & (F.col("editorial_role") == "main-event")
    low = F.lit(-1.0)
    orders = {
        "major": [F.desc(F.coalesce("major_rank", low)), F.desc("informationValue"), F.desc_nulls_last("published_ms"), F.asc("cluster_id")],
        "personal": [F.desc(F.coalesce("personal_rank", low)), F.desc_nulls_last("published_ms"), F.asc("cluster_id")],
        "general": [F.desc(F.coalesce("base_score", low)), F.desc("importance"), F.desc_nulls_last("published_ms"), F.asc("cluster_id")],
    }
    ranked = stored(records)
    keep, firsts = 2 * config.most + 1, None
    for lane, order in orders.items():
        # Only rows of the lane are ranked, and a limit on a rank is taken in each task before rows are shuffled.
        place = F.row_number().over(Window.partitionBy("topic_group").orderBy(*order))
        found = ranked.where(main & F.col(lane)).withColumn("place", place).where(F.col("place") <= keep).select("cluster_id")
        firsts = found if firsts is None else firsts.unionByName(found)
    some = ranked.join(F.broadcast(firsts.distinct()), "cluster_id", "left_semi")  # `keep` rows a lane and topic
    columns = ["cluster_id", "topic_group", "major", "personal", "general", "major_rank", "personal_rank", "base_score", "informationValue", "importance", "published_ms"]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.astype(object).where(rows.notna(), None)
        table = rows.to_dict("records")
        first = {"major": lambda r: (-(r["major_rank"] if r["major_rank"] is not None else -1), -r["informationValue"]), "personal": lambda r: (-(r["personal_rank"] if r["personal_rank"] is not None else -1),), "general": lambda r: (-(r["base_score"] if r["base_score"] is not None else -1), -r["importance"])}
        newest = lambda r: (r["published_ms"] is None, -(r["published_ms"] or 0), r["cluster_id"])
        queue = {lane: sorted((r for r in table if r[lane]), key=lambda r: (*first[lane](r), *newest(r))) for lane in first}
        protected = {r["cluster_id"] for r in queue["major"][: config.major_protect]}
        rank_of = {"major": "major_rank", "personal": "personal_rank", "general": "base_score"}
        why = {"major": "major-news", "personal": "personal-interest", "general": "general-high-value"}
        caps = {"major": config.major_cap, "personal": config.personal_cap, "general": config.most}
        size = {"major": config.most, "personal": config.most, "general": config.target}
        chosen, skipped, topics, lanes = {}, {}, {}, {}
        for lane, rows_ in queue.items():
            for r in rows_:
                name, topic = r["cluster_id"], r["topic_group"]
                if name in chosen:
                    continue
                n = topics.get(topic, 0)
                if len(chosen) >= size[lane]:
                    skipped.setdefault(name, "digest-size")
                elif lanes.get(lane, 0) >= caps[lane]:
                    skipped.setdefault(name, "lower-priority")
                elif not (n < config.topic_free or n < config.topic_soft and lane != "general" or n >= config.topic_soft and lane == "major" and name in protected):
                    skipped.setdefault(name, "category-saturation")
                else:
                    chosen[name] = ("selected", why[lane], lane, len(chosen) + 1, float(r[rank_of[lane]]))
                    topics[topic], lanes[lane] = n + 1, lanes.get(lane, 0) + 1
        out = [(k, *v) for k, v in chosen.items()]
        out += [(k, "rejected", v, None, None, None) for k, v in skipped.items() if k not in chosen]
        return pd.DataFrame(out, columns=["cluster_id", "decision", "reason", "lane", "rank", "priority"]).astype({"rank": "Int32"})

    done = stored(some.select(*columns).groupBy(F.lit("all")).applyInPandas(run, PACKED))
    # A row behind those is refused by what its first lane had reached at its place: the edition's size, the lane's
    # cap, or else its topic. Both are reached at one selected row, and rows after that one meet them.
    keys = {
        "major": F.struct((-F.coalesce("major_rank", low)).alias("a"), (-F.col("informationValue")).cast("double").alias("b"), F.col("published_ms").isNull().alias("c"), (-F.coalesce("published_ms", F.lit(0))).alias("d"), F.col("cluster_id").alias("e")),
        "personal": F.struct((-F.coalesce("personal_rank", low)).alias("a"), F.lit(0.0).alias("b"), F.col("published_ms").isNull().alias("c"), (-F.coalesce("published_ms", F.lit(0))).alias("d"), F.col("cluster_id").alias("e")),
        "general": F.struct((-F.coalesce("base_score", low)).alias("a"), (-F.col("importance")).cast("double").alias("b"), F.col("published_ms").isNull().alias("c"), (-F.coalesce("published_ms", F.lit(0))).alias("d"), F.col("cluster_id").alias("e")),
    }
    taken = done.where("decision = 'selected'").withColumnRenamed("lane", "in").select("cluster_id", "in", "rank").join(records, "cluster_id")
    taken = sorted(taken.select("in", "rank", *[k.alias(f"key_{n}") for n, k in keys.items()]).collect(), key=lambda r: r["rank"])  # `most` rows at most
    lanes, caps = list(keys), {"major": config.major_cap, "personal": config.personal_cap}

    def after(lane: str, row) -> Column:
        k = row[f"key_{lane}"]
        return keys[lane] > F.struct(F.lit(k["a"]).alias("a"), F.lit(k["b"]).alias("b"), F.lit(k["c"]).alias("c"), F.lit(k["d"]).alias("d"), F.lit(k["e"]).alias("e"))

    def refused(lane: str) -> Column:
        limit = config.target if lane == "general" else config.most
        filled = taken[limit - 1] if len(taken) >= limit else None
        own = [r for r in taken if r["in"] == lane]
        capped = own[caps[lane] - 1] if lane in caps and len(own) >= caps[lane] else None
        out = F.lit("category-saturation")
        if capped is not None:
            out = F.when(after(lane, capped), "lower-priority").otherwise(out)
        if filled is not None and lanes.index(filled["in"]) < lanes.index(lane):
            return F.lit("digest-size")
        if filled is not None and filled["in"] == lane:
            out = F.when(after(lane, filled), "digest-size").otherwise(out)
        return out

    late = F.when(F.col("major"), refused("major")).when(F.col("personal"), refused("personal")).when(F.col("general"), refused("general")).otherwise("below-lane-threshold")
    reason = F.when(~F.col("eligible"), F.col("reason_in")).when(F.col("editorial_role") == "related", "redundant").otherwise(late)
    left = ranked.join(done.select("cluster_id"), "cluster_id", "left_anti").withColumnsRenamed({"reason": "reason_in", "lane": "lane_in"})
    rest = left.select("cluster_id", F.lit("rejected").alias("decision"), reason.alias("reason"), F.col("lane_in").alias("lane"), F.lit(None).cast("int").alias("rank"), F.lit(None).cast("double").alias("priority"))
    first_lane = records.select("cluster_id", F.col("lane").alias("first_lane"))
    done = done.join(first_lane, "cluster_id").select("cluster_id", "decision", "reason", F.coalesce("lane", "first_lane").alias("lane"), "rank", "priority")
    return done.unionByName(rest)


def partition_errors(records: DataFrame, decided: DataFrame) -> DataFrame:
    """Empty if every record is decided once."""
    ids = records.select("cluster_id")
    return ids.exceptAll(decided.select("cluster_id")).unionByName(decided.select("cluster_id").exceptAll(ids))


def stats(decided: DataFrame) -> DataFrame:
    return decided.groupBy("decision", F.when(F.col("decision") == "selected", F.col("lane")).otherwise(F.col("reason")).alias("name")).agg(F.count("*").alias("n"))
