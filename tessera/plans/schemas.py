"""The forty tables: columns, keys, references and meanings, as one registry.

A table is a name, its key, and columns as ``name type [-> table.column] [! for required] # meaning``.
Types: text, int, bool, real, date, list (of text), json (kept as text). Columns that may
not be published carry ``private``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES: dict[str, T.DataType] = {
    "text": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "bool": T.BooleanType(),
    "real": T.DoubleType(),
    "date": T.DateType(),
    "list": T.ArrayType(T.StringType()),
    "json": T.StringType(),
}
_PROVENANCE = "source_url text ! # where the row was read; source_document_id text ! # what to cite; retrieved_at text ! # when"

_TABLES = """
person(id): id text # member number or placeholder; first_name text !; last_name text !; name_prefix text; academic_title text; birth_date date; birth_place text; gender text; party text; is_mdb bool ! # a member, not only a speaker; role text; dip_person_id text; aw_politician_id long; wikidata_qid text; @; fraction text # derived: of the latest membership
mandate(id): id text # person/period; person_id text -> person.id !; wahlperiode int !; from_date date !; to_date date # null: still held; mandate_type text; constituency_number int; constituency_name text; state text; @
membership(id): id text; person_id text -> person.id !; wahlperiode int !; kind text ! # fraction, committee or other; name text !; role text; from_date date; to_date date; @
sitting(id): id text # period/number; wahlperiode int !; number int !; date date !; start_time text; end_time text; xml_url text !; pdf_url text !; @; preliminary bool !; final_announced date; final_fetched_at text; first_page int; last_page int # where a preliminary text ends
agenda_item(id): id text # sitting/position; sitting_id text -> sitting.id !; position int !; top_id text !; title text; drucksache_numbers list !; @; no_debate bool !; kind text # derived
agenda_sub_item(id): id text # item/label; agenda_item_id text -> agenda_item.id !; label text !; position int !; title text; drucksache_numbers list !; first_paragraph int !; last_paragraph int !; @; no_debate bool !
agenda_item_vorlage(id): id text; agenda_item_id text -> agenda_item.id !; sub_item_id text -> agenda_sub_item.id; drucksache_number text !; vorgang_id text -> vorgang.id; @; via text ! # title or decision
speech(id): id text; sitting_id text -> sitting.id !; agenda_item_id text -> agenda_item.id; position int !; person_id text -> person.id !; speaker_name text !; speaker_role text; fraction text; text text !; @; kind text ! # rede or fragestunde; sub_item_id text -> agenda_sub_item.id; speaker_group text; member_fraction text; rede_id text; interruption text; interruption_start text
speech_paragraph(id): id text; speech_id text -> speech.id !; position int !; kind text ! # text, chair, comment or procedural; text text !
interjection(id): id text; speech_id text -> speech.id !; paragraph int !; part int !; kind text !; actor text !; fraction text; person_id text -> person.id; name text; text text; to_person_id text -> person.id; to_name text
drucksache(id): id text; number text !; wahlperiode int !; type text; title text !; date date !; pdf_url text; publisher text; originators list !; author_count int; @; originator_groups list # derived
drucksache_author(id): id text; drucksache_id text -> drucksache.id !; dip_person_id text !; person_id text -> person.id; name text !; activity_type text; @
question_activity(id): id text; vorgang_id text !; question_type text !; activity_type text !; dip_person_id text !; person_id text -> person.id; name text !; ressort text; document_kind text !; document_number text !; question_numbers text; page text; @
question_turn(speech_id): speech_id text -> speech.id; role text ! # einleitung, frage, antwort, nachfrage or zusatzfrage; thread_id text -> speech.id; vorgang_id text -> vorgang.id
question_text(id): id text; vorgang_id text -> vorgang.id; drucksache_number text !; drucksache_id text -> drucksache.id; position int !; part text !; number text; text text !; name text; answerer_person_id text -> person.id; answer_date date; thread_id text -> speech.id; @
question_table(id): id text; question_text_id text -> question_text.id !; position int !; after_paragraph int !; cells json !
question_parse(vorgang_id): vorgang_id text -> vorgang.id; status text ! # complete, partial, unanswered or failed; questions int !; answered int !; source_document_id text
vorgang(id): id text; wahlperiode int !; type text; title text !; status text; subjects list !; initiators list !; verkuendung json; inkrafttreten json; @
vorgang_drucksache(vorgang_id, drucksache_id): vorgang_id text -> vorgang.id; drucksache_id text -> drucksache.id
vorgang_position(id): id text; vorgang_id text !; date date !; position text !; chamber text; document_kind text; document_number text; document_type text; pdf_url text; pages text; originators list !; ressort text; decisions json; @
vorgang_referral(position_id, committee): position_id text -> vorgang_position.id; vorgang_id text !; committee text; committee_short text; lead bool !; kind text; @
hib_item(id): id text; number text !; date date !; wahlperiode int !; title text !; ressort text !; kind text !; author_code text; committee text; text text ! private; @
hib_drucksache(hib_id, drucksache_number): hib_id text -> hib_item.id; drucksache_number text; position int !
roll_call_vote(id): id text; sitting_id text -> sitting.id; number int !; date date !; title text !; drucksache_number text; vorgang_id text -> vorgang.id; link_method text; yes int !; no int !; abstain int !; invalid int !; absent int !; xlsx_url text !; pdf_url text; @; agenda_item_id text -> agenda_item.id
individual_vote(id): id text; vote_id text -> roll_call_vote.id !; person_id text -> person.id; last_name text !; first_name text !; fraction text !; vote text !
aw_profile(aw_politician_id): aw_politician_id long; person_id text -> person.id; url text !; questions int; questions_answered int; @
side_job(id): id long; wahlperiode int !; person_id text -> person.id; aw_mandate_id long !; label text !; job_title_extra text; category text; income_level int; income_range text; income real; interval text; additional_information text; organization_id long; organization text; city text; topics list; created date; data_change_date date; @
constituency(id): id text; election text !; number int !; name text !; state text !; seat_party text # null: no seat; electorate int; voters int; @
constituency_result(id): id text; election text !; constituency_number int !; group_kind text !; party text !; vote int !; votes int !; percent real; @
party_fraction(party): party text; fraction text !
constituency_municipality(id): id text; election text !; ags text !; name text !; district text !; state text !; constituency_number int !; split bool !; @
election_candidacy(id): id text; election text !; person_id text -> person.id; last_name text !; first_names text !; birth_year int; party text !; elected_via text !; constituency_number int; first_vote_percent real; list_state text; list_position int; occupation text; @
mandate_successor(id): id text; election text !; predecessor_person_id text -> person.id; predecessor_name text !; predecessor_party text !; predecessor_state text !; predecessor_seat text !; reason text !; person_id text -> person.id; name text !; birth_year int !; party text !; state text !; seat text !; from_date date !; @
person_alias(alias_id): alias_id text; person_id text -> person.id !; recorded_at text !
person_photo(person_id): person_id text -> person.id; image_url text !; credit text; bio_url text; local_path text ! private; @
government_role(id): id text; person_id text -> person.id; wikidata_qid text; name text !; office text !; department text; kind text !; from_date date !; to_date date; @; source_kind text !
agenda_item_paragraph(id): id text; agenda_item_id text -> agenda_item.id !; position int !; kind text !; text text !; @
decision(id): id text; sitting_id text -> sitting.id !; agenda_item_id text -> agenda_item.id; n int !; position int !; kind text !; subject text !; drucksache_number text; result text; roll_call_vote_id text -> roll_call_vote.id; text text !; @; sub_item_id text -> agenda_sub_item.id; vorgang_id text -> vorgang.id; dip_position_id text; dip_result text
decision_vorgang(decision_id, vorgang_id): decision_id text -> decision.id; vorgang_id text -> vorgang.id; via text !
decision_fraction(decision_id, fraction): decision_id text -> decision.id; fraction text; position text !
"""

_COLUMN = re.compile(r"(?P<name>\w+) (?P<type>\w+)(?: -> (?P<table>\w+)\.(?P<column>\w+))?(?P<required> !)?(?P<private> private)?(?: # (?P<meaning>.*))?")


@dataclass(frozen=True)
class Table:
    name: str
    key: tuple[str, ...]
    schema: T.StructType
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def public(self) -> list[str]:
        return [f.name for f in self.schema if not f.metadata.get("private")]


def _table(line: str) -> Table:
    head, columns = line.split("): ", 1)
    name, key = head.split("(")
    keys = tuple(k.strip() for k in key.split(","))
    fields, references = [], {}
    for part in columns.replace("@", _PROVENANCE).split("; "):
        m = _COLUMN.fullmatch(part.strip())
        if not m:
            raise ValueError(f"{name}: {part}")
        meta = {k: v for k, v in (("comment", m["meaning"]), ("private", bool(m["private"]))) if v}
        fields.append(T.StructField(m["name"], _TYPES[m["type"]], not (m["required"] or m["name"] in keys), meta))
        if m["table"]:
            references[m["name"]] = (m["table"], m["column"])
    return Table(name, keys, T.StructType(fields), references)


TABLES: dict[str, Table] = {t.name: t for t in map(_table, _TABLES.strip().splitlines())}


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in TABLES[name].schema]))


def conform(df: DataFrame, name: str) -> DataFrame:
    """``df`` with exactly the table's columns: missing ones null, types cast, others dropped (additive evolution)."""
    there = set(df.columns)
    return df.select(
        *((F.col(f.name) if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[name].schema)
    )


def violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Broken rules of the tables given: (table_name, rule, n), only where n > 0."""
    from tessera.operators.checks import orphans, repeated_keys

    found = []
    for name, df in tables.items():
        t = TABLES[name]
        count = lambda d, rule, name=name: d.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), F.lit(rule).alias("rule"), "n")
        found.append(count(repeated_keys(df, t.key), "key"))
        required = [F.col(f.name).isNull() for f in t.schema if not f.nullable]
        found.append(count(df.where(reduce(lambda a, b: a | b, required)), "required"))
        for c, (parent, key) in t.references.items():
            if parent in tables:
                found.append(count(orphans(df, c, tables[parent], key), f"reference {c}"))
    return reduce(DataFrame.unionByName, found).where("n > 0")
