"""Election files: separated text with a preamble, as plans over lines; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import decimal_comma, iso_date, mapped

#: Numbers of the states in the official order (fixed values).
STATES = {
    str(k): v
    for k, v in enumerate("SH HH NI HB NW HE RP BW BY SL BE BB MV SN ST TH".split(), start=1)
}
#: What stands for "no seat" (fixed value).
NO_SEAT = "–"


def preamble_table(files: DataFrame, header_starts: str, date_label: str, comment: str = "") -> DataFrame:
    """Rows of ``;``-separated files below their header line.

    ``files`` has path and content (text). Gives path, line, as_of (the date of the line
    that starts with ``date_label``, behind a ``;`` or a colon), and ``cells``, a map from
    header to trimmed text. Lines without any cell are no rows.
    """
    lines = files.select("path", F.posexplode(F.split("content", r"\r?\n")).alias("line", "text"))
    first = F.trim(F.split("text", ";")[0])
    w = Window.partitionBy("path")
    is_header, is_date = first == header_starts, F.startswith(F.ltrim("text"), F.lit(comment + date_label))
    day = iso_date(F.regexp_extract("text", r"(\d{1,2}\.\d{1,2}\.\d{4})", 1))
    marked = lines.select(
        "*",
        F.min(F.when(is_header, F.col("line"))).over(w).alias("header_line"),
        F.min_by(F.when(is_header, F.split("text", ";")), F.when(is_header, F.col("line"))).over(w).alias("header"),
        F.max(F.when(is_date, day)).over(w).alias("as_of"),
    )
    rows = marked.where((F.col("line") > F.col("header_line")) & (F.length(F.translate("text", "; ", "")) > 0))
    cells = F.split("text", ";")
    n = F.least(F.size("header"), F.size(cells))
    clean = lambda a: F.transform(F.slice(a, F.lit(1), n), lambda x: F.trim(x))
    # Header names repeat only where they are empty; those cells have no name to ask for.
    pairs = F.filter(F.arrays_zip(clean(F.col("header")).alias("k"), clean(cells).alias("v")), lambda p: p["k"] != "")
    return rows.select("path", "line", "as_of", F.map_from_entries(pairs).alias("cells"))


def _cell(name: str) -> Column:
    """The text of a cell; empty and missing are null."""
    return F.nullif(F.try_element_at("cells", F.lit(name)), F.lit(""))


def _int(name: str) -> Column:
    return _cell(name).try_cast("int")


def elected(files: DataFrame) -> DataFrame:
    """Elected candidates (S8): what decides is whether the constituency or the list elected them."""
    t = preamble_table(files, "Wahlart", "Stand:")
    direct = _cell("Kennzeichen") == "Kreiswahlvorschlag"
    linked = _cell("VerknKennzeichen")
    on_list = F.coalesce(linked == "Landesliste", F.lit(False))
    in_district = F.coalesce(linked == "Kreiswahlvorschlag", F.lit(False))
    return t.select(
        "path",
        F.col("line").alias("position"),
        "as_of",
        _cell("Nachname").alias("last_name"),
        _cell("Vornamen").alias("first_names"),
        _cell("Titel").alias("academic_title"),
        _cell("Namenszusatz").alias("name_prefix"),
        _cell("Geschlecht").alias("gender"),
        _int("Geburtjahr").alias("birth_year"),
        _cell("Geburtsort").alias("birth_place"),
        _cell("Beruf").alias("occupation"),
        _cell("Gruppenname").alias("party"),
        F.when(direct, "constituency").otherwise("list").alias("elected_via"),
        F.when(direct, _int("Gebietsnummer")).when(in_district, _int("VerknGebietsnummer")).alias("constituency_number"),
        F.when(direct, decimal_comma(_cell("Prozent"))).alias("first_vote_percent"),
        F.when(~direct, _cell("GebietLandAbk")).when(on_list, _cell("VerknGebietLandAbk")).alias("list_state"),
        F.when(~direct, _int("Listenplatz")).when(on_list, _int("VerknListenplatz")).alias("list_position"),
    )


def _districts(files: DataFrame) -> DataFrame:
    return preamble_table(files, "Wahlart", "Stand:").where(_cell("Gebietsart") == "Wahlkreis")


def constituencies(files: DataFrame) -> DataFrame:
    """One row a district with two totals pivoted out of the long format."""
    total = lambda name: F.max(F.when((_cell("Gruppenart") == "System-Gruppe") & (_cell("Gruppenname") == name), _int("Anzahl")))
    seat = F.nullif(_cell("Gewählt"), F.lit(NO_SEAT))
    return _districts(files).groupBy("path", "as_of", _int("Gebietsnummer").alias("number")).agg(
        F.min_by(_cell("Gebietsname"), "line").alias("name"),
        F.min_by(mapped(_int("UegGebietsnummer").cast("string"), STATES), "line").alias("state"),
        F.min_by(seat, "line").alias("seat_party"),
        total("Wahlberechtigte").alias("electorate"),
        total("Wählende").alias("voters"),
    )


def constituency_results(files: DataFrame) -> DataFrame:
    """Votes of each party or person in each district, first and second vote."""
    t = _districts(files).where(_cell("Gruppenart") != "System-Gruppe")
    return t.select(
        "path",
        "as_of",
        _int("Gebietsnummer").alias("constituency_number"),
        _int("Gruppenreihenfolge").alias("group_order"),
        F.when(_cell("Gruppenart") == "Partei", "party").otherwise("individual").alias("group_kind"),
        _cell("Gruppenname").alias("party"),
        _int("Stimme").alias("vote"),
        _int("Anzahl").alias("votes"),
        decimal_comma(_cell("Prozent")).alias("percent"),
    ).where("vote IS NOT NULL AND votes IS NOT NULL")


def municipalities(files: DataFrame) -> DataFrame:
    """Municipalities of each district with their composed eight-digit key."""
    t = preamble_table(files, "Wahlkreis-Nr", "Gebietsstand:", comment="# ")
    return t.select(
        "path",
        "as_of",
        F.concat(*(_cell(f"RGS_{part}") for part in ("Land", "RegBez", "Kreis", "Gemeinde"))).alias("ags"),
        _cell("Gemeindename").alias("name"),
        _cell("Kreisname").alias("district"),
        mapped(_int("RGS_Land").cast("string"), STATES).alias("state"),
        _int("Wahlkreis-Nr").alias("constituency_number"),
        _cell("Wahlkreis-von").isNotNull().alias("split"),
    )


#: Parties and a state's other spelling in lists of successors (fixed values).
LISTED_PARTIES = ("CDU", "CSU", "SPD", "AfD", "GRÜNE", "Die Linke", "FDP", "BSW", "SSW")
LISTED_STATES = {"NRW": "NW"}


def _succession() -> str:
    # The printed form of a row (fixed values).
    side = (
        r"([^,\d]+?, [^\d]+?) (\d{4}) (?:.*? )?(" + "|".join(LISTED_PARTIES) + r"), ([A-Z]{2,3}), ((?:LL|WK) \d{3})"
    )
    return rf"^(\d+) {side} (\S+) {side} (\d{{2}}\.\d{{2}}\.\d{{4}})$"


def successors(lines: DataFrame) -> DataFrame:
    """Successions out of text lines (S11); lines that only look like one have ``parsed`` false and nulls.

    ``lines`` has path and text; the text of a PDF comes from whatever reader is at hand.
    """
    text, pattern = F.trim("text"), _succession()
    part = lambda k: F.nullif(F.regexp_extract(text, pattern, k), F.lit(""))
    state = lambda k: mapped(part(k), LISTED_STATES, part(k))
    names = ("predecessor_name", None, "predecessor_party", "predecessor_state", "predecessor_seat", "reason", "name", "birth_year", "party", "state", "seat")
    return lines.where(text.rlike(r"^\d+ .*\d{2}\.\d{2}\.\d{4}$")).select(
        "path",
        text.alias("text"),
        text.rlike(pattern).alias("parsed"),
        part(1).try_cast("int").alias("number"),
        *(
            (state(k) if n.endswith("state") else part(k).try_cast("int") if n == "birth_year" else part(k)).alias(n)
            for k, n in enumerate(names, start=2)
            if n
        ),
        iso_date(part(13)).alias("from_date"),
    )


def citation(kind: str, election: str, as_of: Column) -> Column:
    """A citable source: which file of which election as of when."""
    year = "20" + "".join(c for c in election if c.isdigit())
    return F.format_string(f"Bundeswahlleiterin, BTW {year} {kind} (Stand %s)", as_of.cast("string"))
