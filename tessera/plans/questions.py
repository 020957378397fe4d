"""Steps about questions to the government: turns, texts read out, written answers in annexes, and their procedures."""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.groups import parse_role, speaker_group
from tessera.functions.text import first_token, last_tokens, normalize_name, overlap_ratio, words
from tessera.operators import assign, link, sequence
from tessera.sources.run import per_file

Tables = Mapping[str, DataFrame]

# ---------------------------------------------------------------- turns


@F.pandas_udf(T.StructType([T.StructField("mentions", T.BooleanType()), T.StructField("number", T.StringType()), T.StructField("name", T.StringType())]))
def _question_named(text: pd.Series) -> pd.DataFrame:
    """Whether a paragraph names a question by number, and which one it calls."""
    from tessera.functions.questions import numbered, question_call

    called = [question_call(t) or (None, None) for t in text.fillna("")]
    return pd.DataFrame({"mentions": [bool(numbered(t)) for t in text.fillna("")], "number": [n for n, _ in called], "name": [n for _, n in called]})


@F.pandas_udf(T.StringType())
def _called(chair: pd.Series) -> pd.Series:
    from tessera.functions.questions import call

    return chair.map(lambda c: call([x for x in c if not x.endswith(":")]))


@F.pandas_udf(T.BooleanType())
def _asks_on(opening: pd.Series) -> pd.Series:
    from tessera.functions.questions import asks_on

    return opening.fillna("").map(asks_on)


#: Paragraphs behind a call that may hold the question, and characters of a turn that may name it a follow-up (fixed values).
LONGEST_QUESTION, OPENING = 3, 200


def spoken_calls(under: DataFrame, items: DataFrame, speeches: DataFrame | None = None) -> DataFrame:
    """Questions that the chair calls and reads out (W11), with the item's first document and, of ``speeches`` (id,
    agenda_item_id, position), the first one after the call and before the next, as thread_id.

    A question is what the chair says after the call, up to a paragraph that ends in a question mark, if neither a
    speech nor another number comes between: each paragraph looks at the few behind it.
    """
    w = Window.partitionBy("agenda_item_id").orderBy("position")
    told = under.select("agenda_item_id", "position", "kind", "after_speeches", "text", _question_named("text").alias("q"))
    here = F.struct("kind", "after_speeches", "text", F.col("q.mentions").alias("mentions"))
    told = told.withColumn("behind", F.collect_list(here).over(w.rowsBetween(1, LONGEST_QUESTION)))
    calls = told.where("kind = 'chair' AND q.number IS NOT NULL")
    other = F.transform("behind", lambda p: (p["kind"] != "chair") | (p["after_speeches"] != F.col("after_speeches")) | p["mentions"])
    ends = F.array_position(F.transform("behind", lambda p: F.rtrim(p["text"]).endswith("?")), True)
    stops = F.array_position(other, True)
    whole = calls.where((ends > 0) & ((stops == 0) | (stops > ends)))
    said = F.array_join(F.transform(F.slice("behind", 1, ends.cast("int")), lambda p: p["text"]), "\n\n")
    document = items.select(F.col("id").alias("agenda_item_id"), F.get("drucksache_numbers", 0).alias("drucksache_number"))
    found = whole.select("agenda_item_id", F.col("q.number").alias("number"), F.col("q.name").alias("name"), said.alias("text"), "after_speeches", "position")
    found = found.join(document, "agenda_item_id")
    if speeches is None:
        return found.withColumn("thread_id", F.lit(None).cast("string")).drop("position")
    until = F.lead("after_speeches").over(Window.partitionBy("agenda_item_id").orderBy("position"))
    asked = found.withColumn("until", until).withColumn("call", F.col("position")).drop("position").withColumn("position", F.col("after_speeches").cast("int"))
    spoke = speeches.where("agenda_item_id IS NOT NULL").select("agenda_item_id", F.col("position").cast("int").alias("position"), F.col("id").alias("speech"), F.col("position").cast("int").alias("at"))
    told = link.asof(asked, spoke, ["agenda_item_id"], "position", ["speech", "at"], forward=True, strict=True)
    thread = F.when(F.col("until").isNull() | (F.col("at") <= F.col("until")), F.col("speech"))
    return told.withColumn("thread_id", thread).drop("until", "call", "position", "speech", "at")


def question_turns(speeches: DataFrame, paragraphs: DataFrame, under: DataFrame, items: DataFrame) -> DataFrame:
    """speech_id, role and thread_id of each turn of an interview (items whose title says so) or question time."""
    official = speaker_group(F.col("speaker_role"), F.col("fraction")) == "Bundesregierung"
    kinds = items.select(F.col("id").alias("agenda_item_id"), F.startswith(F.coalesce("title", F.lit("")), F.lit("Befragung der Bundesregierung")).alias("interview"))
    s = speeches.where("agenda_item_id IS NOT NULL").join(kinds, "agenda_item_id").where("interview OR kind = 'fragestunde'")
    # Who held an office in any turn of the item answers in all of them.
    s = s.withColumn("official", F.max(F.coalesce(official, F.lit(False))).over(Window.partitionBy("agenda_item_id", "person_id")))
    return interviews(s.where("interview"), paragraphs, under).unionByName(question_times(s.where("NOT interview"), spoken_calls(under, items)))


def interviews(turns: DataFrame, paragraphs: DataFrame, under: DataFrame) -> DataFrame:
    """Turns of interviews (W9). A member's turn opens a thread when the chair says so or none is open; it goes on with
    the open one when the chair or its own words say so, or the same member goes on; and, if nothing says anything, it
    opens one exactly if the next member to speak is the same one again.

    The chair's words before a turn are those after the last own text of the turn before and those under the item in between.
    """
    w = Window.partitionBy("agenda_item_id").orderBy("position")
    listed = F.transform(F.sort_array(F.collect_list(F.struct("position", "text"))), lambda x: x["text"])  # a turn's paragraphs
    own = paragraphs.where("kind = 'text'").groupBy("speech_id").agg(F.max("position").alias("own"))
    tail = paragraphs.where("kind = 'chair'").join(own, "speech_id", "left").where("own IS NULL OR position > own")
    after = tail.groupBy(F.col("speech_id").alias("id")).agg(listed.alias("after"))
    between = under.where("kind = 'chair'").groupBy("agenda_item_id", (F.col("after_speeches") + 1).cast("int").alias("position")).agg(listed.alias("between"))
    nothing = F.array().cast("array<string>")
    t = turns.withColumn("position", F.col("position").cast("int")).join(after, "id", "left").join(between, ["agenda_item_id", "position"], "left")
    chair = F.concat(F.coalesce(F.lag("after").over(w), nothing), F.coalesce("between", nothing))
    member = F.when(~F.col("official"), F.col("person_id"))
    t = t.withColumns({
        "chair": chair,
        "before": F.last(member, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "next": F.first(member, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)),
    })
    t = t.withColumn("said", _called("chair")).withColumn("asks_on", _asks_on(F.left("text", F.lit(OPENING))))
    # What each turn says of itself, whoever has asked: opens, goes on, or, by the turns around it, opens unless it is the asker's.
    says = (
        F.when(F.col("official"), "answers").when(F.col("said") == "new", "opens")
        .when((F.col("said") == "follow") | F.col("asks_on") | F.col("person_id").eqNullSafe(F.col("before")), "goes on")
        .when(F.col("next").eqNullSafe(F.col("person_id")), "returns").otherwise("goes on")
    )
    start = F.struct(F.lit(None).cast("string").alias("thread"), F.lit(None).cast("string").alias("asker"), F.array().cast("array<struct<speech_id:string,role:string,thread_id:string>>").alias("out"))

    def step(state, turn):
        asks = turn["says"] != "answers"
        opens = asks & (state["thread"].isNull() | (turn["says"] == "opens") | ((turn["says"] == "returns") & ~turn["person_id"].eqNullSafe(state["asker"])))
        thread, asker = F.when(opens, turn["id"]).otherwise(state["thread"]), F.when(opens, turn["person_id"]).otherwise(state["asker"])
        answers = F.when(thread.isNull(), "einleitung").otherwise("antwort")
        role = F.when(~asks, answers).when(opens, "frage").when(turn["person_id"].eqNullSafe(asker), "nachfrage").otherwise("zusatzfrage")
        row = F.struct(turn["id"].alias("speech_id"), role.alias("role"), thread.alias("thread_id"))
        return F.struct(thread.alias("thread"), asker.alias("asker"), F.concat(state["out"], F.array(row)).alias("out"))

    made = sequence.folded(t.withColumn("says", says), ["agenda_item_id"], ["position"], ["id", "person_id", "says"], start, step)
    return made.select(F.inline("state.out"))


def question_times(turns: DataFrame, calls: DataFrame) -> DataFrame:
    """Turns of question times (W9): each belongs to the last question called before it, whose thread is the first turn
    after that call; officials answer, the asker follows up, others put further questions."""
    last = calls.groupBy("agenda_item_id", F.col("after_speeches").cast("int").alias("position")).agg(F.max_by("name", F.col("number").try_cast("int")).alias("name"))
    last = last.select("agenda_item_id", "position", F.col("position").alias("call"), "name")
    t = turns.select("agenda_item_id", F.col("position").cast("int").alias("position"), "id", "last_name", "official")
    found = link.asof(t, last, ["agenda_item_id"], "position", ["call", "name"], strict=True)
    called = Window.partitionBy("agenda_item_id", "call").orderBy("position")
    thread = F.when(F.col("call").isNotNull(), F.first("id").over(called))
    asks = F.array_contains(F.split(normalize_name(F.col("name")), " "), last_tokens(normalize_name(F.col("last_name")), 1))
    role = F.when(F.col("official"), "antwort").when(asks, "nachfrage").otherwise("zusatzfrage")
    return found.select(F.col("id").alias("speech_id"), role.alias("role"), thread.alias("thread_id"))


# ---------------------------------------------------------------- annexes

ELEMENTS = "path string, annex int, n int, title string, class string, text string, cells string"


def table_cells(table: ET.Element) -> dict:
    """A table by sections; a cell that spans more than one place says so."""
    say = lambda el: " ".join("".join(el.itertext()).replace(chr(0xA0), " ").replace(chr(0xAD), "").split())

    def cell(el: ET.Element) -> dict | str:
        wide = {k: int(v) for k, v in el.attrib.items() if k in ("colspan", "rowspan") and v != "1"}
        return {"text": say(el)} | wide if wide else say(el)

    rows = {name: [[cell(c) for c in row.iterfind("*") if c.tag in ("td", "th")] for row in table.iterfind(f"{tag}/tr")] for name, tag in (("head", "thead"), ("body", "tbody"), ("foot", "tfoot"))}
    return {"caption": next(map(say, table.iterfind("caption")), None)} | rows


def annex_elements(files: DataFrame) -> DataFrame:
    """The paragraphs and tables of the annexes that hold written answers of a question time, in order."""

    def run(path: str, content: bytes) -> Iterator[tuple]:
        for k, annex in enumerate(ET.fromstring(content).iter("anlagen-text")):
            title = annex.get("anlagen-typ") or ""
            if "Fragestunde" in title:
                for n, el in enumerate(annex):
                    table = json.dumps(table_cells(el), ensure_ascii=False) if el.tag == "table" else None
                    yield path, k, n, title, el.get("klasse") or "", None if table else "".join(el.itertext()), table

    blanks = F.translate(F.translate("text", chr(0xAD), ""), chr(0xA0), " ")
    return per_file(files, run, ELEMENTS).withColumn("text", F.trim(F.regexp_replace(blanks, r"\s+", " ")))


def annex_answers(files: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """Written answers to questions of a question time, in a report's annexes: what was asked, by whom, and the answer
    with its tables; ``answered`` is false where the annex says that there is none.

    Each element is of one kind; a heading with numbers begins an entry, and what an element belongs to shows by
    where in its entry it stands: before the asker's line, behind it, or behind the answer's. ``own`` (path, document): the documents
    of the sitting's question times; a title whose document is none of them but the end of one's number is a misprint of that.
    """
    said = F.split("text", " ")
    number = F.regexp_extract_all("text", F.lit(r"\w+|[^\w\s]"), F.lit(0))
    only_numbers = F.forall(F.slice(number, 2, 999), lambda x: x.rlike(r"^\d+$") | x.isin(",", "und")) & (F.size(number) > 1) & number[0].isin("Frage", "Fragen")
    of = lambda k: F.get(said, F.lit(k))
    asker = of(0).isin("Frage", "Fragen") & of(1).isin("der", "des") & (of(2) == "Abgeordneten") & F.endswith("text", F.lit(":"))
    joint = (of(0) == "Gemeinsame").cast("int")
    e = annex_elements(files).withColumns({
        "kind": F.when(F.col("cells").isNotNull(), "table").when(F.startswith("class", F.lit("Anlage")) & only_numbers, "heading")
        .when((F.col("class") == "O") & asker, "asker").when((F.col("class") == "O") & (F.get(said, joint) == "Antwort") & F.endswith("text", F.lit(":")), "answer")
        .when(F.col("text") == "", "blank").otherwise("text"),
        # A name stands behind the third word, and before the group in brackets.
        "asks": F.regexp_replace(F.rtrim(F.array_join(F.slice(said, 4, 99), " "), F.lit(":")), r"\s*\([^()]*\)$", ""),
        "tells": F.rtrim(F.array_join(F.slice(said, joint + 3, 99), " "), F.lit(":")),
        "numbers": F.filter(number, lambda x: x.rlike(r"^\d+$")),
        "none": F.contains("text", F.lit("nicht beantwortet")) | F.contains("text", F.lit("bei Redaktionsschluss noch nicht vor")),  # fixed wordings
    })
    entry = Window.partitionBy("path", "annex").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("entry", F.count_if(F.col("kind") == "heading").over(entry)).where("entry > 0")
    whole = Window.partitionBy("path", "annex", "entry")
    e = e.withColumns({k: F.min(F.when(F.col("kind") == v, F.col("n"))).over(whole) for k, v in (("asked_at", "asker"), ("told_at", "answer"))})
    behind = F.coalesce(F.col("n") > F.col("told_at"), F.lit(False))
    part = (
        F.when(F.col("kind").isin("heading", "blank", "answer") | (F.col("n") == F.col("asked_at")), F.lit(None))
        .when(behind, F.when(F.col("kind") == "table", "table").otherwise("answer"))
        .when((F.col("class") == "p") & (F.col("n") > F.col("asked_at")), "question").when(F.col("none"), "none")
    )
    e = e.withColumn("part", part)
    upto = whole.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("after", F.count_if(F.col("part") == "answer").over(upto).cast("int"))
    parts = lambda p, v: F.transform(F.sort_array(F.collect_list(F.when(F.col("part") == p, F.struct("n", v.alias("v"))))), lambda r: r["v"])
    entries = e.groupBy("path", "annex", "entry").agg(
        F.min("n").alias("at"), F.first("title").alias("title"),
        F.max_by("numbers", F.when(F.col("kind") == "heading", F.col("n"))).alias("numbers"),
        F.max_by("asks", F.when(F.col("n") == F.col("asked_at"), F.col("n"))).alias("name"),
        parts("question", F.col("text")).alias("questions"),
        F.max_by("tells", F.when(F.col("kind") == "answer", F.col("n"))).alias("answer_name"),
        parts("answer", F.col("text")).alias("answer"),
        parts("table", F.struct("after", "cells")).alias("tables"),
        (F.count_if(F.col("part") == "none") == 0).alias("answered"),
    )
    document = F.nullif(F.element_at(F.concat(F.array(F.lit("")), F.regexp_extract_all("title", F.lit(r"\b(\d{1,2}/\d{1,6})\b"), F.lit(1))), -1), F.lit(""))
    entries = entries.withColumn("document", document)
    if own is not None:
        held = own.where("document IS NOT NULL").groupBy("path").agg(F.collect_set("document").alias("own"))  # a sitting's
        meant = F.filter("own", lambda d: (F.substring_index(d, "/", 1) == F.substring_index("document", "/", 1)) & F.endswith(d, F.substring_index("document", "/", -1)))
        right = F.when(F.array_contains("own", F.col("document")), F.col("document")).otherwise(F.coalesce(F.array_min(meant), F.col("document")))
        entries = entries.join(held, "path", "left").withColumn("document", F.when(F.col("own").isNull(), F.col("document")).otherwise(right))
    n = F.row_number().over(Window.partitionBy("path").orderBy("annex", "at"))
    return entries.select("path", n.alias("n"), "document", "numbers", "name", "questions", "answer_name", "answer", "tables", "answered")


def question_texts(calls: DataFrame, annex: DataFrame) -> DataFrame:
    """question_text rows (P15): those read out first, with their thread, then the annexes'; of an id that comes twice the
    first stays. A joint answer is stored with each of its questions."""
    thread = F.col("thread_id") if "thread_id" in calls.columns else F.lit(None).cast("string")
    c = calls.select(F.col("drucksache_number").alias("document"), F.col("after_speeches").alias("_n"), "number", F.lit("frage").alias("part"), "text", "name", thread.alias("thread_id"), F.lit(0).alias("_source"))
    whole = F.size("questions") == F.size("numbers")
    e = annex.where("name IS NOT NULL AND size(questions) > 0").select("*", F.posexplode("numbers").alias("k", "number"))
    # Where the questions are not one a number, all of them stand with the first number.
    asked = e.where(whole | (F.col("k") == 0)).select(
        "document", F.col("n").alias("_n"), "number", F.lit("frage").alias("part"),
        F.when(whole, F.get("questions", F.col("k"))).otherwise(F.array_join("questions", "\n\n")).alias("text"), "name", F.lit(1).alias("_source"),
    )
    told = e.where("answered AND answer_name IS NOT NULL AND size(answer) > 0").select(
        "document", F.col("n").alias("_n"), "number", F.lit("antwort").alias("part"), F.array_join("answer", "\n\n").alias("text"), F.col("answer_name").alias("name"), F.lit(1).alias("_source")
    )
    from tessera.operators.dedup import best_row

    every = c.unionByName(asked.unionByName(told), allowMissingColumns=True).withColumn("id", F.concat_ws("/", "document", "number", "part"))
    return best_row(every, ["id"], [F.col("_source"), F.col("_n")]).withColumnRenamed("document", "drucksache_number").drop("_source", "_n")


# ---------------------------------------------------------------- procedures of questions


def surname(printed: Column) -> Column:
    """The last word of a name before its comma, in matching form."""
    return last_tokens(normalize_name(F.split(printed, ",")[0]), 1)


def spoken_procedures(asked: DataFrame, activities: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """Procedures of spoken questions (J15): one asker's questions on a list are paired with the asker's activities by the
    words that text and title share, else in order; a question left over takes the asker's next procedure of the list that
    none has, as the register may have it under a later sitting.

    ``asked``: document, number, name, text; ``activities``: document, vorgang_id, name, title; ``listed``: document,
    vorgang_id, name of all procedures on the lists.
    """
    q = asked.select("document", surname(F.col("name")).alias("asker"), F.col("number").cast("int").alias("number"), words(normalize_name(F.col("text")), 4).alias("_q"))
    a = activities.select("document", surname(F.col("name")).alias("asker"), F.col("vorgang_id").cast("long").alias("vorgang"), words(normalize_name(F.col("title")), 4).alias("_a"))
    pairs = q.join(a, ["document", "asker"]).select("document", "asker", "number", "vorgang", overlap_ratio(F.col("_q"), F.col("_a")).alias("score"))
    best = assign.best_assignment(pairs, ["document", "asker"], "number", "vorgang", "score").select("document", "number", "vorgang")
    if listed is not None:
        nth = lambda c: F.row_number().over(Window.partitionBy("document", "asker").orderBy(c)).alias("nth")
        left = q.join(best, ["document", "number"], "left_anti").select("document", "asker", "number", nth("number"))
        every = listed.select("document", surname(F.col("name")).alias("asker"), F.col("vorgang_id").cast("long").alias("vorgang")).distinct()
        free = every.join(best.select("vorgang").distinct(), "vorgang", "left_anti").select("document", "asker", "vorgang", nth("vorgang"))
        best = best.unionByName(left.join(free, ["document", "asker", "nth"]).select("document", "number", "vorgang"))
    return best.select("document", F.col("number").cast("string").alias("number"), F.col("vorgang").cast("string").alias("vorgang_id"))


def written_procedures(asked: DataFrame, activities: DataFrame) -> DataFrame:
    """Procedures of written questions (J16): the register's with the same number whose asker agrees, the later one of
    two; what is left takes the nearest number of the same asker's that is free, each once."""
    q = asked.select("document", "number", normalize_name(F.col("name")).alias("_name"))
    a = activities.select("document", "vorgang_id", surname(F.col("name")).alias("asker"), F.explode(F.regexp_extract_all("question_numbers", F.lit(r"(\d+)"), F.lit(1))).alias("number"))
    agrees = F.array_contains(F.split("_name", " "), F.col("asker"))
    direct = q.join(a, ["document", "number"]).where(agrees).groupBy("document", "number").agg(F.max_by("vorgang_id", F.struct(F.length("vorgang_id"), "vorgang_id")).alias("vorgang_id"))
    left = q.join(direct, ["document", "number"], "left_anti").withColumn("n", F.col("number").cast("int"))
    free = a.join(direct.select("vorgang_id"), "vorgang_id", "left_anti").withColumnRenamed("number", "other")
    near = left.join(free, "document").where(agrees).groupBy("document", "n", "vorgang_id").agg(F.min(F.abs(F.col("n") - F.col("other").cast("int"))).alias("distance"))
    found = assign.greedy(near, ["document"], "n", "vorgang_id", "distance")
    return direct.unionByName(found.select("document", F.col("n").cast("string").alias("number"), "vorgang_id"))


# ---------------------------------------------------------------- profiles and portraits


def profiles(records: DataFrame, persons: DataFrame, mandates: DataFrame, period: int) -> DataFrame:
    """Profiles of a period's members, matched by name and year; unmatched ones stay, without a person."""
    from tessera.plans.steps import match_persons, with_person

    matched = match_persons(records, "id", "last_name", "first_name", "year_of_birth", persons, mandates, period)
    return with_person(records, matched, "id").select(
        F.col("id").alias("aw_politician_id"), "person_id", F.col("abgeordnetenwatch_url").alias("url"), F.col("statistic_questions").alias("questions"),
        F.col("statistic_questions_answered").alias("questions_answered"), F.col("api_url").alias("source_url"),
        F.concat(F.lit("aw politician "), F.col("id").cast("string")).alias("source_document_id"), "retrieved_at",
    )


def portraits(cards: DataFrame, persons: DataFrame, mandates: DataFrame, period: int, others: DataFrame) -> DataFrame:
    """One picture a person (P28, J12): the cards' before ``others`` (person_id, image_url, credit); of a person's cards
    the last. A card is matched by name, else by surname, first given name and group if that is one person."""
    from tessera.operators.dedup import best_row, first_of_sources
    from tessera.plans.steps import match_persons

    c = cards.withColumn("card", F.concat_ws("/", "path", "n")).where("image_url IS NOT NULL")
    by_name = match_persons(c, "card", "last_name", "first_name", None, persons, mandates, period)
    p = persons.select("id", last_tokens(normalize_name(F.col("last_name")), 1).alias("_l"), first_token(normalize_name(F.col("first_name"))).alias("_f"), F.col("fraction"))
    k = c.select("card", last_tokens(normalize_name(F.col("last_name")), 1).alias("_l"), first_token(normalize_name(F.col("first_name"))).alias("_f"), "fraction")
    by_group = k.join(p, ["_l", "_f", "fraction"]).groupBy("card").agg(F.when(F.min("id") == F.max("id"), F.min("id")).alias("_id"))
    found = c.join(by_name, "card").join(by_group, "card", "left").withColumn("person_id", F.coalesce("matched_id", "_id")).where("person_id IS NOT NULL")
    own = best_row(found, ["person_id"], [F.col("path").desc(), F.col("n").desc()]).select("person_id", "image_url", "credit", "bio_url")
    return first_of_sources([own, others], ["person_id"])


def offices_not_in_roster(t: Tables) -> DataFrame:
    """Speakers with a federal office whom the roster of offices lacks."""
    role = parse_role(F.col("speaker_role"))
    spoke = t["speech"].where(role.isNotNull()).select("person_id", "speaker_role").distinct()
    return spoke.join(t["government_role"].select("person_id"), "person_id", "left_anti")
