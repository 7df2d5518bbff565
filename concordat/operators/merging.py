"""Merging a list's rows into the settled set: objects, flows, decisions, creations.

Rows are (uuid, name, cas, ec, words, iri, unit); objects (object_id, pref, alts, cas, ec, qualifier);
flows (flow_id, object_id, iri, words, unit). Every step is a join or a window over one row's own
candidates, so that rows spread over the cluster; no step depends on the order of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names, text
from ..functions.text import canonical_label
from . import contexts
from .groups import closure
from .match import overlap_score

#: Reasons after which a flow may be created in the row's own context.
CREATABLE = ("no-candidates-same-dimension-media", "tied-elementary-candidates", "context-contradiction", "no-candidate-in-stated-context")


def index(objects: DataFrame) -> dict[str, DataFrame]:
    """Inverted indexes (k, object_id, numbered, own): numbers, folded labels and preferred labels."""
    base = objects.select("object_id", "qualifier", "cas", "ec", canonical_label(F.col("pref")).alias("own"), F.transform(F.coalesce("alts", F.array().cast("array<string>")), canonical_label).alias("others"), (F.size(F.coalesce("cas", F.array().cast("array<string>"))) > 0).alias("numbered"))
    one = lambda c: base.select("object_id", "qualifier", "numbered", "own", F.explode(F.array_distinct(c)).alias("k"))
    return {"cas": one(F.col("cas")), "ec": one(F.col("ec")), "label": one(F.array_union(F.array("own"), "others")), "pref": one(F.array("own"))}


def evidence(rows: DataFrame, objects: DataFrame, key: str = "uuid") -> DataFrame:
    """(key, object_id, bases): which objects a row's numbers and name reach, and by what."""
    ix, none = index(objects), F.array().cast("array<string>")
    asked = {"cas": F.coalesce("cas", none), "ec": F.coalesce("ec", none), "label": F.array(canonical_label(F.col("name")))}
    found = reduce(DataFrame.unionAll, [rows.select(key, F.explode(c).alias("k")).join(ix[b].select("k", "object_id"), "k").select(key, "object_id", F.lit(b).alias("basis")) for b, c in asked.items()])
    return found.groupBy(key, "object_id").agg(F.array_join(F.array_sort(F.collect_set("basis")), ",").alias("bases"))


def enriched(unmatched: DataFrame, objects: DataFrame, key: str = "uuid") -> DataFrame:
    """Unmatched rows with the number of objects that any evidence reaches, and the kinds of evidence."""
    e = evidence(unmatched, objects, key).groupBy(key).agg(F.count(F.lit(1)).alias("objects"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.split("bases", ","))))), ",").alias("bases"))
    return unmatched.join(e, key, "left").select(*unmatched.columns, F.coalesce("objects", F.lit(0)).alias("objects"), F.coalesce("bases", F.lit("")).alias("bases"))


def _bare_element(label: Column, own: Column) -> Column:
    """Whether a name says an ion and the candidate is the bare element that the ion is of."""
    ion = names.ion_parts(label)
    return ion.isNotNull() & (canonical_label(ion["base"]) == own)


def candidates(rows: DataFrame, objects: DataFrame, historical: DataFrame, key: str = "uuid") -> DataFrame:
    """All candidates (key, tier, basis, object_id and what they agree on) of every rung at once.

    Labels count on numbered objects only where they are preferred, and an ion's name never reaches its
    bare element. Derived spellings count for rows that say ``dialect``; ``historical`` has (name, now).
    """
    ix, none = index(objects), F.array().cast("array<string>")
    own, last = canonical_label(F.col("name")), canonical_label(F.element_at(F.split("name", ","), -1))
    r = rows.select(key, "name", own.alias("__own"), text.qualifier(F.col("name")).alias("__q"), last.alias("__last"), F.coalesce("cas", none).alias("cas"), F.coalesce("ec", none).alias("ec"), F.coalesce("dialect", F.lit(False)).alias("dialect"))
    now = r.join(historical.select(canonical_label(F.col("name")).alias("__own"), canonical_label(F.col("now")).alias("__now")), "__own").select(key, "__now")
    asks = [
        ("cas", 0, r.select(key, F.explode("cas").alias("k")), ix["cas"]),
        ("ec", 1, r.select(key, F.explode("ec").alias("k")), ix["ec"]),
        ("label", 2, r.select(key, F.col("__own").alias("k")), ix["label"]),
        ("dialect", 3, r.where("dialect").select(key, F.explode(F.transform(names.aliases(F.col("name")), canonical_label)).alias("k")), ix["label"]),
        ("historical-name", 4, now.select(key, F.col("__now").alias("k")), ix["label"]),
    ]
    found = reduce(DataFrame.unionAll, [a.join(i, "k").select(key, "object_id", "qualifier", "numbered", "own", F.lit(n).alias("tier"), F.lit(b).alias("basis"), F.col("k").alias("__k")) for b, n, a, i in asks])
    found = found.join(r.select(key, "name", "__own", "__q", "__last"), key)
    proper = (F.col("tier") != 2) | ((~F.col("numbered") | (F.col("own") == F.col("__own"))) & ~F.coalesce(_bare_element(F.col("name"), F.col("own")), F.lit(False)))
    found = found.where(proper).groupBy(key, "object_id", "tier", "basis", "__own", "__q", "__last").agg(F.max("qualifier").alias("qualifier"), F.max("own").alias("own"))
    for ask, flag in (("__own", "named"), ("__last", "designated")):
        labels = ix["label"].select("object_id", F.col("k").alias(ask), F.lit(True).alias(flag)).distinct()
        found = found.join(labels, ["object_id", ask], "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    return found.select(key, "tier", "basis", "object_id", (F.col("__q").isNotNull()).alias("asks"), F.coalesce(F.col("qualifier") == F.col("__q"), F.lit(False)).alias("carries"), yes("named").alias("named"), yes("designated").alias("designated"), (F.col("own") == F.col("__own")).alias("preferred"))


def resolve_objects(rows: DataFrame, objects: DataFrame, curated: DataFrame, historical: DataFrame, key: str = "uuid") -> DataFrame:
    """(key, object_id, basis, reason): a curated object, else the first rung with a candidate, narrowed
    until one is left. Several numbers' objects of which none carries the row's qualifier are none."""
    w = Window.partitionBy(key)
    c = candidates(rows, objects, historical, key)
    c = c.withColumn("__first", F.min("tier").over(w)).where("tier = __first")

    def narrowed(df: DataFrame, flag: str, mark: str, when: Column) -> DataFrame:
        n, hits = F.count(F.lit(1)).over(w), F.count_if(F.col(flag)).over(w)
        df = df.withColumns({"__n": n, "__hits": hits})
        use = when & (F.col("__n") > 1) & (F.col("__hits") > 0)
        df = df.where(~use | F.col(flag))
        return df.withColumn("basis", F.when(use & (F.col("__hits") < F.col("__n")), F.concat("basis", F.lit(mark))).otherwise(F.col("basis")))

    number = F.col("tier") == 0
    lost = (F.count(F.lit(1)).over(w) > 1) & F.col("asks") & number & (F.count_if(F.col("carries")).over(w) == 0)
    c = c.withColumn("__lost", lost)
    c = narrowed(c, "carries", "+qualifier", number & F.col("asks"))
    c = narrowed(c, "named", "+label", number)
    c = narrowed(c, "designated", "+designation", number)
    c = narrowed(c, "preferred", "+preferred-name", F.lit(True))
    g = c.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("object_id").alias("object_id"), F.min("basis").alias("basis"), F.bool_or("__lost").alias("lost"))
    known = objects.select(F.col("object_id").alias("__known"))
    cur = curated.select(key, F.col("object_id").alias("__cur"))
    out = rows.select(key).join(g, key, "left").join(cur, key, "left").join(known, F.col("__cur") == F.col("__known"), "left")
    fixed, one = F.col("__cur").isNotNull(), (F.col("n") == 1) & ~F.col("lost")
    reason = F.when(fixed & F.col("__known").isNull(), "no-flow-object-candidate").when(~fixed & F.col("n").isNull(), "no-flow-object-candidate").when(~fixed & F.col("lost"), "no-candidate-with-qualifier").when(~fixed & (F.col("n") > 1), "multiple-flow-object-candidates")
    return out.select(key, F.when(fixed, F.col("__known")).when(one, F.col("object_id")).alias("object_id"), F.when(fixed & F.col("__known").isNotNull(), "curated").when(~fixed & one, F.col("basis")).alias("basis"), reason.alias("reason"))


def select_flow(rows: DataFrame, flows: DataFrame, vocabulary: DataFrame, allowed: DataFrame, key: str = "uuid") -> DataFrame:
    """(key, target, reason, score): which flow of its object a row is, by context and unit.

    Candidates cross neither dimension nor media. One in the row's own context is it; otherwise those that
    say no more than the row score by unit and shared words, and a tie, a contradiction of what the row
    says, or a stated context that no candidate is in, is no match.
    """
    w = Window.partitionBy(key)
    f = flows.select("object_id", F.col("flow_id").alias("target"), F.col("iri").alias("__iri"), F.col("words").alias("__words"), F.col("unit").alias("__unit"))
    j = rows.select(key, "object_id", "words", "iri", "unit").join(f, "object_id")
    first = lambda c, k: F.get(F.col(c), k)
    same = reduce(lambda a, b: a & b, [first("words", k).isNull() | first("words", k).eqNullSafe(first("__words", k)) for k in (0, 1)])
    met = j.groupBy(key).agg(F.count_if(same).alias("near"))
    c = contexts.contradictions(j.where(same), vocabulary, allowed, "iri", "__iri")
    exact = F.coalesce(F.col("__iri") == F.col("iri"), F.lit(False))
    c = c.withColumns({"__exact": exact, "__within": F.size(F.array_except("__words", "words")) == 0})
    c = c.withColumns({"__exacts": F.count_if(F.col("__exact")).over(w), "__fit": F.count_if(F.col("__within")).over(w)})
    alone = F.col("__exacts") == 1
    c = c.where((alone & F.col("__exact")) | (~alone & ((F.col("__fit") == 0) | F.col("__within"))))
    score = overlap_score(F.coalesce(F.col("unit") == F.col("__unit"), F.lit(False)), F.col("words"), F.col("__words"), F.col("__exact"))
    c = c.withColumn("score", score)

    def best(df: DataFrame, mark: str) -> DataFrame:
        top = df.groupBy(key).agg(F.max("score").alias("top"), F.bool_or("__exact").alias("in_it"), F.max("__exacts").alias("exacts"))
        hit = df.join(top, key).where("score = top")
        return hit.groupBy(key, "top", "in_it", "exacts").agg(F.count(F.lit(1)).alias("ties"), F.min("target").alias("target"), F.bool_or("contradicts").alias("contradicts")).select(key, *[F.col(x).alias(f"{mark}{x}") for x in ("top", "in_it", "exacts", "ties", "target", "contradicts")])

    a, b = best(c, "a_"), best(c.where("not contradicts"), "b_")
    out = rows.select(key, "object_id", "iri").join(met, key, "left").join(a, key, "left").join(b, key, "left")
    sole = F.col("a_exacts") == 1
    second = F.col("a_contradicts") & ~sole
    pick = lambda x: F.when(second, F.col(f"b_{x}")).otherwise(F.col(f"a_{x}"))
    no_signal, tied = F.coalesce(F.col("a_top"), F.lit(0)) <= 0, F.col("a_ties") > 1
    worse = second & (F.coalesce(F.col("b_top"), F.lit(0)) <= 0) | second & (F.coalesce(F.col("b_ties"), F.lit(2)) > 1)
    nowhere = F.col("iri").isNotNull() & ~F.coalesce(pick("in_it"), F.lit(False))
    reason = (
        F.when(F.col("near").isNull(), "no-elementary-candidates").when(F.col("near") == 0, "no-candidates-same-dimension-media").when(sole, "exact-context-iri-match")
        .when(no_signal, "no-context-or-unit-signal").when(tied, "tied-elementary-candidates").when(worse, "context-contradiction").when(nowhere, "no-candidate-in-stated-context").otherwise("best-score")
    )
    hit = reason.isin("exact-context-iri-match", "best-score")
    return out.select(key, F.when(hit, pick("target")).alias("target"), reason.alias("reason"), F.when(hit, pick("top")).alias("score"))


def added_contexts(rows: DataFrame, flows: DataFrame) -> DataFrame:
    """(flow_id, object_id, iri, unit, rows): flows to create for rows whose object is known but not in
    the row's context; each (object, context) once, and none that is there already."""
    want = rows.where(F.col("reason").isin(*CREATABLE) & F.col("object_id").isNotNull() & F.col("iri").isNotNull())
    new = want.groupBy("object_id", "iri").agg(F.min_by("unit", "uuid").alias("unit"), F.count(F.lit(1)).alias("rows"))
    new = new.withColumn("flow_id", names.minted_flow_id(F.col("object_id"), F.col("iri")))
    return new.join(flows.select("object_id", "iri"), ["object_id", "iri"], "left_anti").select("flow_id", "object_id", "iri", "unit", "rows")


def created_objects(rows: DataFrame, objects: DataFrame) -> DataFrame:
    """(uuid, object_id, blocked): objects to create for rows that reach none. Rows that share their
    smallest number are one object, rows without a number one by folded name; an id that is there
    already blocks its rows."""
    number = F.array_min(F.coalesce("cas", F.array().cast("array<string>")))
    basis = F.coalesce(number, canonical_label(F.col("name")))
    new = rows.where("reason = 'no-flow-object-candidate'").select("uuid", names.stable_id("obj", basis).alias("object_id"))
    held = objects.select("object_id", F.lit(True).alias("__held"))
    return new.join(held, "object_id", "left").select("uuid", "object_id", F.coalesce("__held", F.lit(False)).alias("blocked"))


def admitted(rows: DataFrame, prepared: DataFrame, key: str = "uuid") -> DataFrame:
    """Prepared rows whose name guard, where there is one, is the row's own name."""
    p = prepared.select(key, "target", "guard")
    return rows.select(key, "name").join(p, key).where(F.col("guard").isNull() | (canonical_label(F.col("guard")) == canonical_label(F.col("name")))).select(key, "target")


def prepared_decisions(rows: DataFrame, prepared: DataFrame, redirects: DataFrame, flows: DataFrame, vocabulary: DataFrame, allowed: DataFrame, key: str = "uuid") -> DataFrame:
    """(key, target, verdict): curated targets, followed through replacements; several, one that is gone
    and one whose context denies the row's are no match."""
    ends = closure(redirects, "id", "replaced_by").select(F.col("id").alias("target"), "terminal", "status")
    p = admitted(rows, prepared, key).join(ends, "target", "left").select(key, F.when(F.col("status").isNull(), F.col("target")).otherwise(F.col("terminal")).alias("target")).distinct()
    one = p.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("target").alias("target"))
    j = one.join(flows.select(F.col("flow_id").alias("target"), F.col("iri").alias("__to")), "target", "left").join(rows.select(key, "iri"), key)
    j = contexts.contradictions(j, vocabulary, allowed, "iri", "__to")
    verdict = F.when(F.col("n") > 1, "ambiguous").when(F.col("__to").isNull(), "gone").when(F.col("contradicts"), "context").otherwise("prepared")
    return j.select(key, F.when(verdict == "prepared", F.col("target")).alias("target"), verdict.alias("verdict"))


def canonicalized(rows: DataFrame, identities: DataFrame, key: str = "uuid") -> DataFrame:
    """Rows whose name and numbers are those of the newest identity that their uuid has had."""
    new = identities.groupBy(key).agg(F.max_by(F.struct("name", "cas"), "version").alias("__i"))
    return rows.join(new, key, "left").withColumns({"name": F.coalesce("__i.name", "name"), "cas": F.coalesce("__i.cas", "cas")}).drop("__i").select(*rows.columns)


def merged(rows: DataFrame, objects: DataFrame, flows: DataFrame, vocabulary: DataFrame, allowed: DataFrame, curated: DataFrame, historical: DataFrame, prepared: DataFrame, redirects: DataFrame) -> DataFrame:
    """(uuid, outcome, target, basis, reason): exactly one outcome of every row, against one snapshot.

    Prepared decisions come first, then the algorithm; then flows are created in contexts that an object
    lacks, and objects that no row reaches. Rows see nothing that other rows create.
    """
    p = prepared_decisions(rows, prepared, redirects, flows, vocabulary, allowed).select("uuid", F.col("target").alias("__p"), "verdict")
    o = resolve_objects(rows, objects, curated, historical).select("uuid", "object_id", "basis", F.col("reason").alias("__o"))
    r = rows.join(o, "uuid")
    s = select_flow(r.where("object_id is not null"), flows, vocabulary, allowed).select("uuid", F.col("target").alias("__s"), F.col("reason").alias("__r"))
    j = r.join(s, "uuid", "left").join(p, "uuid", "left")
    by_hand, found = F.col("__p").isNotNull(), F.col("__s").isNotNull()
    reason = F.coalesce("__o", "__r")
    creates = reason.isin(*CREATABLE) & F.col("iri").isNotNull() | (reason == "no-flow-object-candidate") & F.col("iri").isNotNull()
    held = objects.select(F.col("object_id").alias("__new"), F.lit(True).alias("__held"))
    number = F.array_min(F.coalesce("cas", F.array().cast("array<string>")))
    new = F.coalesce(F.col("object_id"), names.stable_id("obj", F.coalesce(number, canonical_label(F.col("name")))))
    j = j.withColumn("__new", new).join(held, "__new", "left")
    blocked = (reason == "no-flow-object-candidate") & F.coalesce("__held", F.lit(False))
    outcome = F.when(by_hand, "prepared").when(found, "algorithm").when(creates & ~blocked, "created").otherwise("unmatched")
    target = F.when(by_hand, F.col("__p")).when(found, F.col("__s")).when(outcome == "created", names.minted_flow_id(F.col("__new"), F.col("iri")))
    return j.select("uuid", outcome.alias("outcome"), target.alias("target"), F.when(by_hand, "prepared").otherwise(F.col("basis")).alias("basis"), F.when(~by_hand, reason).alias("reason"))


def recorded_names(decisions: DataFrame) -> DataFrame:
    """(name, iri, target): what all recorded decisions about a folded name in a context agree on."""
    g = decisions.groupBy(canonical_label(F.col("name")).alias("name"), "iri").agg(F.min("target").alias("lo"), F.max("target").alias("hi"))
    return g.where("lo = hi").select("name", "iri", F.col("lo").alias("target"))


def lookup(questions: DataFrame, decisions: DataFrame, objects: DataFrame, flows: DataFrame, vocabulary: DataFrame, allowed: DataFrame, curated: DataFrame, historical: DataFrame) -> DataFrame:
    """(uuid, target, tier, reason) of a batch of questions: what was decided about this very identifier,
    what all decisions about the name in this context agree on, and only then the algorithm."""
    by_id = decisions.groupBy("uuid").agg(F.min("target").alias("lo"), F.max("target").alias("hi")).where("lo = hi").select("uuid", F.col("lo").alias("__id"))
    by_name = recorded_names(decisions).select(F.col("name").alias("__n"), F.col("iri").alias("__i"), F.col("target").alias("__name"))
    q = questions.join(by_id, "uuid", "left").join(by_name, (canonical_label(F.col("name")) == F.col("__n")) & (F.col("iri") == F.col("__i")), "left").drop("__n", "__i")
    known = F.col("__id").isNotNull() | F.col("__name").isNotNull()
    rest = q.where(~known).select(*questions.columns)
    r = rest.join(resolve_objects(rest, objects, curated, historical).select("uuid", "object_id", F.col("reason").alias("__o")), "uuid")
    s = select_flow(r.where("object_id is not null"), flows, vocabulary, allowed).select("uuid", F.col("target").alias("__s"), F.col("reason").alias("__r"))
    found = r.join(s, "uuid", "left").select("uuid", F.col("__s").alias("target"), F.lit("algorithm").alias("tier"), F.coalesce("__o", "__r").alias("reason"))
    held = q.where(known).select("uuid", F.coalesce("__id", "__name").alias("target"), F.when(F.col("__id").isNotNull(), "identifier").otherwise("name").alias("tier"), F.lit(None).cast("string").alias("reason"))
    return held.unionAll(found)


def replayed(outcomes: DataFrame, answers: DataFrame) -> DataFrame:
    """(outcome, verdict, rows): recorded outcomes against the answers that the matcher gives today."""
    j = outcomes.select("uuid", "outcome", F.col("target").alias("__was")).join(answers.select("uuid", "target"), "uuid", "left")
    verdict = F.when(F.col("__was").eqNullSafe(F.col("target")), "same").when(F.col("target").isNull(), "lost").when(F.col("__was").isNull(), "found").otherwise("other")
    return j.groupBy("outcome", verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("rows"))


def published_conversion(matches: DataFrame, stated: DataFrame, curated: DataFrame, units: DataFrame) -> DataFrame:
    """(uuid, factor, origin): the stated factor if its units still are the pair's, else the curated one,
    else the unit table's; equal units need none."""
    pair = ["uuid", "source_unit", "target_unit"]
    a, b = (units.select(F.col("unit").alias(f"{s}_unit"), F.col("kind").alias(f"__{s}k"), F.col("reference").alias(f"__{s}r"), F.col("multiplier").alias(f"__{s}m")) for s in ("source", "target"))
    j = matches.join(stated.select(*pair, F.col("factor").alias("__s")), pair, "left").join(curated.select("source_unit", "target_unit", F.col("factor").alias("__c")), ["source_unit", "target_unit"], "left").join(a, "source_unit", "left").join(b, "target_unit", "left")
    table = F.when((F.col("__sourcek") == F.col("__targetk")) & (F.col("__sourcer") == F.col("__targetr")), F.col("__sourcem") / F.col("__targetm"))
    same = F.col("source_unit") == F.col("target_unit")
    origin = F.when(F.col("__s").isNotNull(), "stated").when(same, "none-needed").when(F.col("__c").isNotNull(), "curated").when(table.isNotNull(), "unit-table").otherwise("unknown")
    kinds = F.col("__sourcek").isNotNull() & F.col("__targetk").isNotNull() & (F.col("__sourcek") != F.col("__targetk"))
    yearly = lambda c: F.regexp_replace(c, r"[*·. ]?a$", "")
    time = (F.col("source_unit") != F.col("target_unit")) & (yearly(F.col("source_unit")) == yearly(F.col("target_unit")))
    return j.select("uuid", F.coalesce("__s", F.when(same, 1.0), "__c", table).alias("factor"), origin.alias("origin"), kinds.alias("crosses_kinds"), time.alias("crosses_time"))


def unit_mismatches(matches: DataFrame, allowed: DataFrame) -> DataFrame:
    """Matches whose units differ, without the pairs that are allowed to."""
    return matches.where(~F.col("source_unit").eqNullSafe(F.col("target_unit"))).join(allowed.select("source_unit", "target_unit"), ["source_unit", "target_unit"], "left_anti")


def unrecorded_groupings(matches: DataFrame, recorded: DataFrame) -> DataFrame:
    """(target, sources): targets that several source rows were folded into, without a record of it."""
    g = matches.groupBy("target").agg(F.count_distinct("uuid").alias("n"), F.array_join(F.array_sort(F.collect_set("uuid")), ",").alias("sources")).where("n > 1")
    return g.join(recorded.select("target"), "target", "left_anti")
