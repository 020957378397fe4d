"""Registers: members' master data (XML), roll calls (XLSX), office holders and pictures (JSON)."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.groups import normalize_fraction
from tessera.functions.text import clean_text, iso_date, unescape_html

_NAME = "struct<NACHNAME: string, VORNAME: string, ADEL: string, PRAEFIX: string, AKAD_TITEL: string, HISTORIE_BIS: string>"
_INSTITUTION = "struct<INSART_LANG: string, INS_LANG: string, MDBINS_VON: string, MDBINS_BIS: string, FKT_LANG: string>"
_PERIOD = (
    "struct<WP: int, MDBWP_VON: string, MDBWP_BIS: string, WKR_NUMMER: string, WKR_NAME: string, WKR_LAND: string, "
    f"LISTE: string, MANDATSART: string, INSTITUTIONEN: struct<INSTITUTION: array<{_INSTITUTION}>>>"
)
MEMBER = (
    f"ID string, NAMEN struct<NAME: array<{_NAME}>>, "
    "BIOGRAFISCHE_ANGABEN struct<GEBURTSDATUM: string, GEBURTSORT: string, GESCHLECHT: string, PARTEI_KURZ: string>, "
    f"WAHLPERIODEN struct<WAHLPERIODE: array<{_PERIOD}>>"
)

#: Kinds of institutions (fixed values); all others are ``other``.
INSTITUTIONS = {"Fraktion/Gruppe": "fraction", "Ausschuss": "committee", "Unterausschuss": "committee"}


def _empty(c: Column | str) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def members(spark: SparkSession, path: str) -> DataFrame:
    """The master data, one nested row a member."""
    return spark.read.format("xml").option("rowTag", "MDB").schema(MEMBER).load(path)


def persons(raw: DataFrame) -> DataFrame:
    """One row a member: the name without an end date, else the last; prefix of nobility before the other."""
    names = F.col("NAMEN.NAME")
    current = F.filter(names, lambda n: F.coalesce(_empty(n["HISTORIE_BIS"]), F.lit("")) == "")
    name = F.coalesce(F.get(current, 0), F.element_at(names, -1))
    bio = F.col("BIOGRAFISCHE_ANGABEN")
    return raw.select(
        F.col("ID").alias("id"),
        F.coalesce(name["VORNAME"], F.lit("")).alias("first_name"),
        F.coalesce(name["NACHNAME"], F.lit("")).alias("last_name"),
        _empty(F.concat_ws(" ", _empty(name["ADEL"]), _empty(name["PRAEFIX"]))).alias("name_prefix"),
        _empty(name["AKAD_TITEL"]).alias("academic_title"),
        iso_date(bio["GEBURTSDATUM"]).alias("birth_date"),
        _empty(bio["GEBURTSORT"]).alias("birth_place"),
        _empty(bio["GESCHLECHT"]).alias("gender"),
        _empty(bio["PARTEI_KURZ"]).alias("party"),
        F.lit(True).alias("is_mdb"),
    )


def mandates(raw: DataFrame) -> DataFrame:
    w = raw.select(F.col("ID").alias("person_id"), F.explode("WAHLPERIODEN.WAHLPERIODE").alias("w"))
    number = F.col("w.WKR_NUMMER").try_cast("int")
    return w.select(
        F.concat_ws("/", "person_id", F.col("w.WP")).alias("id"),
        "person_id",
        F.col("w.WP").alias("wahlperiode"),
        iso_date(F.col("w.MDBWP_VON")).alias("from_date"),
        iso_date(F.col("w.MDBWP_BIS")).alias("to_date"),
        _empty("w.MANDATSART").alias("mandate_type"),
        F.nullif(number, F.lit(0)).alias("constituency_number"),
        _empty("w.WKR_NAME").alias("constituency_name"),
        F.coalesce(_empty("w.WKR_LAND"), _empty("w.LISTE")).alias("state"),
    )


def memberships(raw: DataFrame) -> DataFrame:
    w = raw.select(F.col("ID").alias("person_id"), F.explode("WAHLPERIODEN.WAHLPERIODE").alias("w"))
    m = w.select("person_id", F.col("w.WP").alias("wahlperiode"), F.posexplode("w.INSTITUTIONEN.INSTITUTION").alias("n", "i"))
    table = F.create_map(*(F.lit(x) for p in INSTITUTIONS.items() for x in p))
    kind = F.coalesce(F.try_element_at(table, F.col("i.INSART_LANG")), F.lit("other"))
    name = F.coalesce("i.INS_LANG", F.lit(""))
    return m.select(
        F.concat_ws("/", "person_id", "wahlperiode", F.col("n") + 1).alias("id"),
        "person_id",
        "wahlperiode",
        kind.alias("kind"),
        F.when(kind == "fraction", normalize_fraction(name)).otherwise(name).alias("name"),
        _empty("i.FKT_LANG").alias("role"),
        iso_date(F.col("i.MDBINS_VON")).alias("from_date"),
        iso_date(F.col("i.MDBINS_BIS")).alias("to_date"),
    )


# ---------------------------------------------------------------- roll calls

#: Columns of a result sheet and the vote that a 1 in them means (fixed values).
VOTE_COLUMNS = {"ja": "yes", "nein": "no", "enthaltung": "abstain", "ungültig": "invalid", "nichtabgegeben": "absent"}
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Cells of the first sheet of an XLSX file, which is XML in a ZIP archive."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml"))]
        sheet = sorted(n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))[0]
        for row in ET.fromstring(z.read(sheet)).iterfind(".//m:row", _NS):
            out: list[str | None] = []
            for cell in row.iterfind("m:c", _NS):
                at = 0
                for ch in re.match(r"[A-Z]*", cell.get("r", ""))[0]:
                    at = at * 26 + ord(ch) - 64
                out += [None] * (max(at, len(out) + 1) - 1 - len(out))
                value = cell.findtext("m:v", None, _NS)
                if cell.get("t") == "s" and value is not None:
                    value = shared[int(value)]
                elif cell.get("t") == "inlineStr":
                    value = "".join(t.text or "" for t in cell.iter(f"{{{_NS['m']}}}t"))
                out.append(value)
            yield out


VOTES = "path string, wahlperiode int, sitting int, number int, row int, last_name string, first_name string, printed_fraction string, vote string"


def individual_votes(files: DataFrame) -> DataFrame:
    """One row a member of each result sheet (S6), the one-hot columns folded into a value."""
    from tessera.sources.run import per_file

    def rows(path: str, content: bytes) -> Iterator[tuple]:
        header: list[str] = []
        for n, cells in enumerate(sheet_rows(content)):
            if not header:
                header = [(c or "").strip().lower() for c in cells]
                continue
            r = dict(zip(header, cells, strict=False))
            if not r.get("name"):
                continue
            vote = next((v for c, v in VOTE_COLUMNS.items() if int(float(r.get(c) or 0)) == 1), None)
            keys = (int(float(r[c])) for c in ("wahlperiode", "sitzungnr", "abstimmnr"))
            yield (path, *keys, n, r["name"].strip(), (r.get("vorname") or "").strip(), r.get("fraktion/gruppe") or "", vote)

    votes = per_file(files, rows, VOTES)
    return votes.withColumn("fraction", normalize_fraction(F.col("printed_fraction"))).drop("printed_fraction")


def roll_calls(votes: DataFrame) -> DataFrame:
    """Totals of each roll call, counted from its rows (A10)."""
    return votes.groupBy("wahlperiode", "sitting", "number").agg(*(F.count_if(F.col("vote") == v).alias(v) for v in VOTE_COLUMNS.values()))


# ---------------------------------------------------------------- office holders

#: Kinds of offices, highest first, and the class that each statement of an office names (fixed values).
OFFICE_KINDS = ("kanzler", "minister", "staatsminister", "parl_sts", "beamteter_sts")
OFFICE_CLASSES = {
    "Q4970706": "kanzler",
    "Q248352": "minister",
    "Q30545012": "minister",
    "Q2325058": "staatsminister",
    "Q813386": "staatsminister",
    "Q19731005": "parl_sts",
    "Q22703996": "beamteter_sts",
}
_FIELDS = "st person personLabel familyLabel birth partyShort partyLabel image pos posLabel deptLabel class start end".split()
BINDINGS = T.StructType([T.StructField("results", T.StructType([T.StructField("bindings", T.ArrayType(T.StructType([T.StructField(f, T.StructType([T.StructField("value", T.StringType())])) for f in _FIELDS])))]))])


def office_statements(files: DataFrame) -> DataFrame:
    """One row a statement of an office (S12): repeated rows folded, a value only where it is the only one."""
    parsed = F.from_json("content", BINDINGS)["results"]["bindings"]
    rows = files.select(F.explode(parsed).alias("b")).select(*(F.col(f"b.{f}.value").alias(f) for f in _FIELDS))
    tail = lambda c: F.element_at(F.split(c, "/"), -1)
    only = lambda c: F.when(F.min(c) == F.max(c), F.min(c))
    short = F.when(F.count("partyShort") > 0, only("partyShort")).otherwise(only("partyLabel"))
    kinds = F.create_map(*(F.lit(x) for p in OFFICE_CLASSES.items() for x in p))
    image = F.min("image")
    return (
        rows.groupBy(tail("st").alias("id"))
        .agg(
            tail(F.min("person")).alias("wikidata_qid"),
            F.min("personLabel").alias("name"),
            only("familyLabel").alias("family_name"),
            F.to_date(F.left(F.min("birth"), F.lit(10))).alias("birth_date"),
            short.alias("party"),
            F.when(image.isNotNull(), F.concat(F.lit("File:"), F.url_decode(tail(image)))).alias("image"),
            F.min("posLabel").alias("office"),
            tail(F.min("pos")).alias("position_qid"),
            F.min("deptLabel").alias("department"),
            F.try_element_at(kinds, tail(F.min("class"))).alias("kind"),
            F.to_date(F.left(F.min("start"), F.lit(10))).alias("from_date"),
            F.to_date(F.left(F.min("end"), F.lit(10))).alias("to_date"),
        )
    )


def split_label(label: Column, family: Column) -> Column:
    """(first, last) of a printed name: the family name if the label ends with it, else the last word."""
    ends = F.coalesce(F.endswith(label, F.concat(F.lit(" "), family)), F.lit(False))
    last = F.when(ends, family).otherwise(F.element_at(F.split(label, " "), -1))
    first = F.rtrim(F.substring(label, F.lit(1), F.length(label) - F.length(last)))
    return F.struct(first.alias("first"), last.alias("last"))


COMMONS = T.ArrayType(T.StructType([T.StructField("title", T.StringType()), T.StructField("imageinfo", T.ArrayType(T.StructType([T.StructField("thumburl", T.StringType()), T.StructField("descriptionurl", T.StringType()), T.StructField("extmetadata", T.StructType([T.StructField(k, T.StructType([T.StructField("value", T.StringType())])) for k in ("Artist", "LicenseShortName")]))])))]))


def commons_images(files: DataFrame) -> DataFrame:
    """Title, address and credit of pictures (S13); those without a thumbnail are left out."""
    pages = files.select(F.explode(F.from_json("content", COMMONS)).alias("p")).select("p.title", F.get("p.imageinfo", 0).alias("i"))
    plain = lambda c: clean_text(unescape_html(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", "")))
    author = F.coalesce(F.nullif(plain(F.col("i.extmetadata.Artist.value")), F.lit("")), F.lit("unbekannt"))
    licence = F.nullif(plain(F.col("i.extmetadata.LicenseShortName.value")), F.lit(""))
    return pages.where("i.thumburl IS NOT NULL").select(
        "title", F.col("i.thumburl").alias("thumb_url"), F.col("i.descriptionurl").alias("page_url"), F.concat_ws(", ", author, licence).alias("credit")
    )
