"""Link the place ids that mean the same restaurant, from names as people typed them.

A noisy channel. Frequent spellings of a region are the candidates for what a variant stands for. The posterior of a
candidate combines how frequent it is (prior), how likely its name is mistyped, abbreviated or shortened to the variant,
and how well phone, door and position agree or disagree. Every likelihood is learnt from all candidate pairs by
expectation maximisation, as the ratio between one restaurant and two, so evidence counts against a link as well as
for it. A variant is attached to the candidate of the greatest posterior, if one restaurant is more probable than two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import shown
from ..session import checkpoint
from .linking import components, deletion_keys, pairs, with_edits
from .parsing import Vocabulary, address, edits_within, name, name_evidence, phone, sound, website

#: Share of all spellings that a word must be in to be common; words a name can have in common are at most 1 / COMMON a word.
COMMON, BESIDE = 0.002, 4
#: Names of one core up to which pairs that meet by name alone teach the fit; those of more would outweigh all others. All are scored.
COMPANY = 20
#: Edits up to which names are compared; edits by which a website's word may differ from the name it corrects.
MOST, WEB_EDITS = 6, 3
#: Sides, in degrees, of the cells in which positions agree, and of the regions in which a name means one restaurant.
CELL, REGION = 0.002, 1.0

#: Levels of spelling by edits a letter, and of kinds, with log likelihood ratios of one restaurant against two before any data.
SPELLING = {"equal": 5.5, "to 0.12": 4.5, "to 0.22": 2.5, "to 0.34": -1.0, "to 0.42": -5.0, "to 0.5": -6.5, "more": -9.0}
KINDS = {"equal": 1.0, "fewer, one choice": -0.5, "fewer": -2.5, "other": -9.0}
#: What is compared, with the same ratios: the prior of the fit. A name is one field, as slips say little where the kinds differ.
FIELDS: dict[str, dict[str, float]] = {
    "name": {f"{a}; {b}": v + w for a, v in SPELLING.items() for b, w in KINDS.items()},
    "given": {"equal": 1.0, "none": 0.3, "one": -0.5, "other": -6.0},
    "phone": {"equal": 5.0, "none": 0.0, "other": -1.0},
    "door": {"equal": 4.0, "none": 0.0, "other": -1.0},
    "position": {"near": 3.5, "none": 0.0, "same region": -0.7, "far": -8.0},
}
#: Log odds of one restaurant against two in a candidate pair before any data, and how many pairs of a level the prior of the fit weighs.
PRIOR, WEIGHT = -1.0, 100.0

WORDS = "what string, word string, other string"


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for text in b.column("name").to_pylist():
            beside, phrases = name_evidence(text)
            rows += [("own", w, o) for w, o in beside] + [("initials", i, p) for i, p in phrases]
        cols = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["what", "word", "other"])


def _towns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        towns = [t for a in b.column("address").to_pylist() for t in {address(a)["town"].split(" ")[0]} - {""}]
        yield pa.RecordBatch.from_arrays([pa.array(towns, pa.string())], names=["word"])


def vocabulary(m: DataFrame) -> Vocabulary:
    """Common words, towns and initials of the corpus, from all rows of :func:`mentions`.

    A word is common if it is in a share of :data:`COMMON` of all names and stands beside names that begin in
    :data:`BESIDE` ways or more; initials stand for the most frequent pair of kinds that begin so. Both lists are bounded:
    the shares of all words sum to the words of a name, and there are 36 ** 2 initials.
    """
    names = m.filter("name is not null").select("name").distinct()
    n = names.count()
    seen = names.mapInArrow(_words, WORDS).groupBy("what", "word", "other").agg(F.count(F.lit(1)).alias("n"))
    least = max(3.0, COMMON * n)
    own = seen.filter("what = 'own'").groupBy("word").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("ways")).filter((F.col("n") >= least) & (F.col("ways") >= BESIDE)).select("word")
    initials = seen.filter("what = 'initials'").groupBy("word").agg(F.max_by("other", F.struct("n", "other")).alias("other"))
    addresses = m.filter("address is not null").select("address").distinct()
    towns = addresses.mapInArrow(_towns, "word string").groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= max(3.0, COMMON * n)).select("word")
    none = F.lit(None).cast("string")
    got = own.select(F.lit("own").alias("what"), "word", none.alias("other")).unionByName(towns.select(F.lit("town").alias("what"), "word", none.alias("other"))).unionByName(initials.select(F.lit("initials").alias("what"), "word", "other")).collect()
    of = lambda what: frozenset(r.word for r in got if r.what == what)
    return Vocabulary(of("own") - of("town"), of("town"), {r.word: r.other for r in got if r.what == "initials"})


FORM = "place_id string, core string, heard string, given string, kinds string, own boolean"


def _forms(known: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["place_id", "core", "heard", "given", "kinds", "own"]
        for b in batches:
            rows = set()
            for pid, text, site in zip(b.column("place_id").to_pylist(), b.column("name").to_pylist(), b.column("website").to_pylist()):
                p = name(text, known)
                core, given, kinds, own = p["core"], p["given"], p["kinds"], bool(p["core"])
                if not own:  # a name without a word of its own is known by its given name, else by its kind
                    core, given, kinds = (given, "", kinds) if len(given) > 1 else (kinds.replace(" ", ""), given, "")
                if not core:
                    continue
                w = website(site)
                cores = {core, w} if own and w and edits_within(sound(w), sound(core), WEB_EDITS) <= WEB_EDITS else {core}
                rows.update((pid, c, sound(c), given, kinds, own) for c in cores)
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in cols[:5]], pa.array(cols[5], pa.bool_())], names=names)

    return run


EVIDENCE = "place_id string, via string, what string"


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: set[tuple] = set()
        for pid, tel, adr, lat, lng in zip(*(b.column(c).to_pylist() for c in ("place_id", "phone", "address", "lat", "lng"))):
            if tel and (p := phone(tel)):
                out.add((pid, "phone", p))
            if adr:
                a = address(adr)
                if a["number"] and a["street"]:
                    s = a["street"] if a["street"].isdigit() else sound(a["street"])[:2]
                    out.update((pid, "door", f"{n} {s}") for n in {a["number"], a["other"]} - {""})
            if lat and lng and abs(lat) <= 90 and abs(lng) <= 180:
                for i in (0.0, 0.5):  # two grids, so that near positions share a cell of at least one
                    out.add((pid, "position", f"{i} {int((lat / CELL + i) // 1)} {int((lng / CELL + i) // 1)}"))
                    out.add((pid, f"region {i}", f"{int((lat / REGION + i) // 1)} {int((lng / REGION + i) // 1)}"))
        cols = list(zip(*sorted(out))) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["place_id", "via", "what"])


def mentions(current: DataFrame, places: DataFrame) -> DataFrame:
    """(place_id, name, website, phone, address, lat, lng): the distinct rows of both tables, without outer spaces."""
    t = lambda c: shown(F.col(c)).alias(c)
    a = current.select("place_id", t("name"), t("website"), t("phone"), t("address"), "lat", "lng")
    none = lambda c: F.lit(None).cast("string").alias(c)
    b = places.select("place_id", shown(F.col("place")).alias("name"), none("website"), none("phone"), t("address"), "lat", "lng")
    return a.unionByName(b).filter("place_id is not null").distinct()


def _set(c: str) -> Column:
    return F.array_remove(F.split(F.col(c), " "), "")


def spellings(m: DataFrame, known: Vocabulary, evidence: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(place_id, node), the nodes, and links (a, b) of one spelling over the border of a region.

    A node is a spelling in a region: core, given name and kinds as read from the name. Places that spell their name
    alike in one region share it, so blocks hold a spelling once however many places have it; places without a position
    share one node of no region, places with several have a node in each region. A core that is no word of the name's
    own tells no restaurant: its nodes are split by door, else phone, else place. ``n`` counts places, ``rep`` is the
    smallest, ``size`` counts the names of the core.
    """
    forms = m.filter("name is not null").select("place_id", "name", "website").distinct().mapInArrow(_forms(known), FORM).distinct()
    first = lambda via: F.min(F.when(F.col("via") == via, F.col("what")))
    of = evidence.groupBy("place_id").agg(first("door").alias("door"), first("phone").alias("phone"))
    region = lambda i, c: evidence.filter(F.col("via") == f"region {i}").select("place_id", F.col("what").alias(c))
    sets = forms.select("heard", "given", "kinds").distinct()
    company = sets.groupBy("heard").agg(F.count(F.lit(1)).alias("size"), F.max(F.size(_set("kinds"))).alias("most"), F.size(F.array_distinct(F.flatten(F.collect_set(_set("kinds"))))).alias("every"))
    company = company.select("heard", "size", (F.col("most") == F.col("every")).alias("one_choice"))
    forms = forms.join(company, "heard").withColumnRenamed("own", "telling").join(of, "place_id", "left").join(region(0.0, "home"), "place_id", "left").na.fill("", ["home"])
    apart = F.when(F.col("telling"), F.lit("")).otherwise(F.coalesce("door", "phone", "place_id"))
    node = ["core", "heard", "given", "kinds", "telling", "size", "one_choice", "home"]
    forms = checkpoint(forms.withColumn("node", F.xxhash64("core", "given", "kinds", "home", apart)).select("place_id", "node", *node, F.col("door").isNotNull().alias("has_door"), F.col("phone").isNotNull().alias("has_phone")))
    nodes = forms.groupBy("node", *node).agg(F.count(F.lit(1)).cast("int").alias("n"), F.min("place_id").alias("rep"), F.bool_or("has_door").alias("has_door"), F.bool_or("has_phone").alias("has_phone"))
    spelling = ["core", "given", "kinds", "shifted"]
    sides = forms.filter("telling").join(region(0.5, "shifted"), "place_id").groupBy(*spelling, "home").agg(F.min("place_id").alias("a"))
    over = sides.groupBy(*spelling).agg(F.collect_list("a").alias("sides"), F.min("a").alias("b")).select(F.explode("sides").alias("a"), "b")
    return forms.select("place_id", "node"), checkpoint(nodes), over


def candidates(shown_as: DataFrame, nodes: DataFrame, evidence: DataFrame) -> DataFrame:
    """(node, top, phone, door, position): each two nodes that share a block, once, the more frequent one as ``top``.

    Telling names meet in a region by a deletion key of the core with the kinds and the initial, or by the core as it
    sounds; names without a region meet those of every region. Any names meet by a phone, a door or a cell of positions
    if their kinds, their beginning or their end are alike: one slip leaves a beginning or an end as it was.
    """
    base = nodes.filter("telling")
    spelt = base.select("node", "n", "home", F.explode(F.transform(deletion_keys("core"), lambda k: F.xxhash64(F.lit("kinds"), k, "kinds", F.substring("given", 1, 1)))).alias("k"))
    heard = base.select("node", "n", "home", F.xxhash64(F.lit("heard"), "heard").alias("k"))
    keyed = spelt.unionByName(heard)
    rarer = (F.col("n") < F.col("top_n")) | ((F.col("n") == F.col("top_n")) & (F.col("node") > F.col("top")))
    none = [F.lit(0).alias(v) for v in ("phone", "door", "position")]

    def met(one: DataFrame, other: DataFrame, *by: str) -> DataFrame:
        return one.join(other.select(*by, F.col("node").alias("top"), F.col("n").alias("top_n")), list(by))

    here = keyed.select("node", "n", F.xxhash64("k", "home").alias("k"))
    alike = met(here, here, "k").filter(rarer).select("node", "top")
    lost, found = keyed.filter("home = ''"), keyed.filter("home <> ''")
    both = met(lost.select("node", "n", "k"), found, "k")
    alike = alike.unionByName(both.select(F.when(rarer, F.col("node")).otherwise(F.col("top")).alias("node"), F.when(rarer, F.col("top")).otherwise(F.col("node")).alias("top")))
    own = F.array(F.concat(F.lit("="), "kinds"), F.concat(F.lit("^"), F.substring("heard", 1, 3)), F.concat(F.lit("$"), F.expr("right(heard, 3)")))
    via = shown_as.join(evidence.filter("via in ('phone', 'door', 'position')"), "place_id").select("node", "via", "what").distinct()
    via = via.join(nodes.select("node", "n", own.alias("own")), "node").select("node", "n", "via", F.explode(F.transform("own", lambda o: F.xxhash64("via", "what", o))).alias("k"))
    agree = met(via, via.drop("via"), "k").filter(rarer)
    agree = agree.select("node", "top", *[(F.col("via") == v).cast("int").alias(v) for v in ("phone", "door", "position")])
    return alike.select("node", "top", *none).unionByName(agree).groupBy("node", "top").agg(*[F.max(v).alias(v) for v in ("phone", "door", "position")])


def compared(met: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, top, n, top_n, *fields, form, top_form, teaches): the pairs of :func:`candidates`, field by field.

    A field of :data:`FIELDS` is a level; the forms are the kinds and the given name of both.
    """
    carry = ["n", "core", "heard", "given", "kinds", "size", "one_choice", "home", "has_phone", "has_door"]
    d = met.join(nodes.select("node", *carry), "node").join(nodes.select(F.col("node").alias("top"), *[F.col(c).alias(f"top_{c}") for c in carry]), "top")
    d = with_edits(with_edits(d, "core", "top_core", MOST, "d"), "heard", "top_heard", MOST, "h")
    off = F.least(F.col("d"), F.col("h")) / F.least(F.length("heard"), F.length("top_heard"))
    spelling = F.when(off.isNull(), 6).when(off == 0, 0).when(off <= 0.12, 1).when(off <= 0.22, 2).when(off <= 0.34, 3).when(off <= 0.42, 4).when(off <= 0.5, 5).otherwise(6)
    within = (F.size(F.array_except(_set("kinds"), _set("top_kinds"))) == 0) | (F.size(F.array_except(_set("top_kinds"), _set("kinds"))) == 0)
    kinds = F.when(F.col("kinds") == F.col("top_kinds"), 0).when(within & (F.col("one_choice") | F.col("top_one_choice")), 1).when(within, 2).otherwise(3)
    a, b = F.col("given"), F.col("top_given")
    initial = (F.least(F.length(a), F.length(b)) <= 1) & ((a == "") | (b == "") | (F.left(a, F.lit(1)) == F.left(b, F.lit(1))))
    given = F.when((a == "") & (b == ""), 1).when(a == b, 0).when(initial, 2).otherwise(3)
    told = lambda c: F.when(F.col(c) == 1, 0).when(F.col(f"has_{c}") & F.col(f"top_has_{c}"), 2).otherwise(1)
    at = lambda c, i: F.split_part(F.col(c), F.lit(" "), F.lit(i)).try_cast("int")
    near = (F.abs(at("home", 1) - at("top_home", 1)) <= 1) & (F.abs(at("home", 2) - at("top_home", 2)) <= 1)
    where = F.when(F.col("position") == 1, 0).when((F.col("home") == "") | (F.col("top_home") == ""), 1).when(near, 2).otherwise(3)
    levels = {"name": spelling * len(KINDS) + kinds, "given": given, "phone": told("phone"), "door": told("door"), "position": where}
    forms = [F.struct(F.col(f"{c}kinds").alias("kinds"), F.col(f"{c}given").alias("given")).alias(f"{c}form") for c in ("", "top_")]
    teaches = (F.greatest("size", "top_size") <= COMPANY) | (F.greatest("phone", "door", "position") == 1)
    return d.select("node", "top", "n", "top_n", *[v.cast("int").alias(c) for c, v in levels.items()], *forms, teaches.alias("teaches"))


def _virtual(ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:data:`WEIGHT` virtual pairs for each level, split into one restaurant and two so that the ratios come out as given."""
    low, high = -30.0, 30.0
    for _ in range(80):
        odds = (low + high) / 2
        p = 1 / (1 + np.exp(-(ratios + odds)))
        low, high = (odds, high) if odds < np.log(p.sum() / (1 - p).sum()) else (low, odds)
    return WEIGHT * p, WEIGHT * (1 - p)


def learnt(patterns: np.ndarray, counts: np.ndarray, rounds: int = 1_000) -> tuple[float, list[np.ndarray]]:
    """(log odds of one restaurant, log likelihood ratios by field and level), fitted to how often each pattern occurs.

    Expectation maximisation of two classes in which fields are independent. The prior of :data:`FIELDS` weighs as much
    as :data:`WEIGHT` pairs of each level, so it decides where there are few data and gives way where there are many. A
    larger distance never speaks more for one restaurant than a smaller one.
    """
    match, other = zip(*(_virtual(np.array(list(levels.values()))) for levels in FIELDS.values()))
    ratios, odds = [np.array(list(levels.values())) for levels in FIELDS.values()], PRIOR
    first = 1 / (1 + np.exp(-PRIOR))
    for _ in range(rounds if len(counts) else 0):
        z = odds + sum(w[patterns[:, f]] for f, w in enumerate(ratios))
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        before, odds = odds, np.log((counts @ p + WEIGHT * first) / (counts @ (1 - p) + WEIGHT * (1 - first)))
        for f, w in enumerate(ratios):
            a, b = (np.bincount(patterns[:, f], counts * q, len(w)) + v for q, v in ((p, match[f]), (1 - p, other[f])))
            ratios[f] = np.log(a / a.sum()) - np.log(b / b.sum())
        if abs(odds - before) < 1e-9:
            break
    ratios[0] = np.minimum.accumulate(ratios[0].reshape(len(SPELLING), len(KINDS))).ravel()
    return float(odds), ratios


def choices(pairs_: DataFrame) -> DataFrame:
    """Adds ``choices``: of how many names that exclude each other one of a pair can be the other, 1 if it can be one only.

    Names of one sound in a region exclude each other if their kinds or given names differ. A name can be any of those
    that have kinds besides its own, or a given name where it has an initial or none; or, as likely as the fit says, any
    of those that have other kinds, or another given name. An initial is one of the given names that it begins.
    """
    kinds, given = F.col("name") % len(KINDS), F.col("given")
    apart = (kinds >= 2) | (given >= 2)
    alike = pairs_.filter(apart & (F.col("name") < len(KINDS)))
    sides = alike.select(F.col("node").alias("side"), "name", "given", F.col("form").alias("own"), F.col("top_form").alias("other"))
    sides = sides.unionByName(alike.select(F.col("top").alias("side"), "name", "given", F.col("top_form").alias("own"), F.col("form").alias("other")))
    fewer = F.length("own.kinds") < F.length("other.kinds")
    ways = sides.filter("given < 3").groupBy("side").agg(F.count_distinct(F.when((kinds == 2) & fewer, F.col("other.kinds"))).alias("k2"), F.count_distinct(F.when(kinds == 3, F.col("other.kinds"))).alias("k3"))
    called = sides.filter((kinds < 3) & ((given == 3) | (given == 2) & (F.length("own.given") < F.length("other.given")))).withColumn("initial", F.left("other.given", F.lit(1)))
    called = called.groupBy("side", "given", "initial").agg(F.greatest(F.lit(1), F.count_distinct(F.when(F.length("other.given") > 1, F.col("other.given")))).alias("names"))
    called = called.groupBy("side").agg(*[F.sum(F.when(given == i, F.col("names"))).alias(f"g{i}") for i in (2, 3)])
    every = ["k2", "k3", "g2", "g3"]
    counts = ways.unionByName(called, allowMissingColumns=True).groupBy("side").agg(*[F.max(c).alias(c) for c in every])
    of = lambda side: counts.select(F.col("side").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in every])
    most = [F.when(level == int(c[1]), F.greatest(f"node_{c}", f"top_{c}")) for c in every for level in [kinds if c[0] == "k" else given]]
    several = pairs_.filter(apart).join(of("node"), "node", "left").join(of("top"), "top", "left").withColumn("choices", F.greatest(F.lit(1).cast("bigint"), *most))
    return pairs_.filter(~apart).withColumn("choices", F.lit(1).cast("bigint")).unionByName(several.select(*pairs_.columns, "choices"))


def scored(pairs_: DataFrame) -> DataFrame:
    """Adds ``score``, the log odds that two nodes mean one restaurant, learnt from the pairs that teach.

    Pairs whose names differ in more than half of their letters show the fit what two restaurants look like, and are
    then left out: they are no spellings of each other. A name that can be one of several is each of them with the same
    probability as far as the names go: phone, door and near positions choose.
    """
    rows = pairs_.filter("teaches").groupBy(*FIELDS).agg(F.count(F.lit(1)).alias("c")).collect()  # at most 4,032 patterns
    odds, ratios = learnt(np.array([[r[f] for f in FIELDS] for r in rows], dtype=int).reshape(-1, len(FIELDS)), np.array([float(r.c) for r in rows]))
    ratio = {f: lambda level, w=w: F.element_at(F.array(*[F.lit(float(x)) for x in w]), level + 1) for f, w in zip(FIELDS, ratios)}
    score = F.lit(odds)
    for f in FIELDS:
        score = score + ratio[f](F.col(f))
    by_name = F.lit(odds) + ratio["name"](F.col("name")) + ratio["given"](F.col("given")) + ratio["position"](F.when(F.col("position") == 0, 2).otherwise(F.col("position")))
    others = F.log(F.col("choices") + (F.col("choices") - 1) * F.exp(by_name))
    spelt = choices(pairs_).filter(F.col("name") < (len(SPELLING) - 1) * len(KINDS))
    return spelt.withColumn("score", score - others).drop("form", "top_form", "teaches", "choices")


def attached(pairs_: DataFrame) -> DataFrame:
    """(node, top): every node with its most probable candidate, the log of its frequency added as prior."""
    over = pairs_.filter("score > 0").groupBy("node").agg(F.max_by("top", F.struct(F.col("score") + F.log("top_n"), "top")).alias("top"))
    return over.select("node", "top")


def link(current: DataFrame, places: DataFrame) -> DataFrame:
    """(a, b): links between place ids of one restaurant, for :func:`linking.components`."""
    m = checkpoint(mentions(current, places))
    evidence = checkpoint(m.select("place_id", "phone", "address", "lat", "lng").distinct().mapInArrow(_evidence, EVIDENCE).distinct())
    shown_as, nodes, over = spellings(m, vocabulary(m), evidence)
    links = attached(scored(checkpoint(compared(candidates(shown_as, nodes, evidence), nodes))))
    rep = nodes.select("node", "rep")
    same = shown_as.join(rep, "node").select(F.col("place_id").alias("a"), F.col("rep").alias("b"))
    links = links.join(rep.withColumnRenamed("rep", "a"), "node").join(rep.select(F.col("node").alias("top"), F.col("rep").alias("b")), "top").select("a", "b")
    return links.unionByName(same).unionByName(over).filter("a <> b").distinct()


def same_restaurant(current: DataFrame, places: DataFrame) -> DataFrame:
    """(place_id, restaurant): each place id that has a partner with its class, named by its smallest id.

    Null and blank names, phones and addresses, null or zero positions and rows without a place id are no evidence;
    repeated rows count once; a place whose names are all blank has no partner. Empty tables give no rows; other
    columns are ignored. Names alike in regions that do not touch are different restaurants, unless a place was in both.
    """
    return components(link(current, places)).select(F.col("node").alias("place_id"), F.col("component").alias("restaurant"))


def same_restaurant_pairs(current: DataFrame, places: DataFrame) -> DataFrame:
    """(place_id_a, place_id_b): all pairs of different ids of a class, the smaller first."""
    classes = components(link(current, places))
    return pairs(classes, "place_id_a", "place_id_b")


