"""Explicit schemas for the three accident-statistics tables (semicolon
separated, header row). Reading with a schema skips the inference pass and
lets Catalyst prune to the projected columns."""

from __future__ import annotations

from pyspark.sql import types as T

INTEGER, STRING, DOUBLE = T.IntegerType(), T.StringType(), T.DoubleType()

# Column names and types of the accident table, in file order.
# Fields of no set type are text.
ACCIDENT_FIELDS = (
    ("Onnett_id", INTEGER), ("Tienpit", INTEGER), ("Tienpitsel", STRING), ("Tie", INTEGER), ("Aosa", INTEGER), ("Aet", INTEGER),
    ("Ajr", INTEGER), ("Vuosi", INTEGER), ("Kk", INTEGER), ("Päivä", STRING), ("Kuolleet", INTEGER), ("Loukkaant", INTEGER),
    ("Vakavuusko", INTEGER), ("Vakavuus", STRING), ("ELY", INTEGER), ("Elynimi", STRING), ("Poliisipri", INTEGER),
    ("Piirinimi", STRING), ("Tunti", INTEGER), ("Vkpv", STRING), ("Ontyyppi", INTEGER), ("Ontyypsel", STRING),
    ("Onluokka", INTEGER), ("Onlksel", STRING), ("Osallkm", INTEGER), ("Nopraj", INTEGER), ("Taajmerk", INTEGER),
    ("Taajamasel", STRING), ("Pinta", INTEGER), ("Pintasel", STRING), ("Valoisuus", INTEGER), ("Valsel", STRING),
    ("Sää", INTEGER), ("Sääsel", STRING), ("Onnpaikka", INTEGER), ("Onnpaiksel", STRING), ("Liikvalot", INTEGER),
    ("Liikvalsel", STRING), ("Liittyvtie", STRING), ("Maakunta", INTEGER), ("Maakuntsel", STRING), ("Kunta", INTEGER),
    ("Kuntasel", STRING), ("Noplaji", INTEGER), ("Noplajisel", STRING), ("Nopsuunvas", INTEGER), ("Nopsuunoik", INTEGER),
    ("Taajama", STRING), ("Mo_mol", INTEGER), ("Mo_molsel", STRING), ("Toimluokka", INTEGER), ("Toimlksel", STRING),
    ("Kvl", INTEGER), ("Raskaskvl", INTEGER), ("Tienlev", INTEGER), ("X", INTEGER), ("Y", INTEGER), ("Oslakpvm", STRING),
    ("Tietyö", STRING), ("Päällyste", INTEGER), ("Päällsel", STRING), ("Lämpötila", INTEGER), ("Risteys", INTEGER),
    ("Risteyssel", STRING), ("Rautatie", INTEGER), ("Rautatsel", STRING), ("Muuliit", INTEGER), ("Muuliitsel", STRING),
    ("Katuosoite", STRING), ("Tietyyppi", INTEGER), ("Tietyypsel", STRING), ("Talvhoitlk", INTEGER), ("Talvhoitsel", STRING),
    ("Tienverkas", INTEGER), ("Tienverkse", STRING), ("Maankäyttö", INTEGER), ("Maankäytse", STRING), ("Valoohjaus", INTEGER),
    ("Valoohjsel", STRING), ("Lisäkaisty", INTEGER), ("Lisäkaisse", STRING), ("Solmutyyp", INTEGER), ("Solmutyyps", STRING),
    ("Liitluok", INTEGER), ("Liitlksel", STRING), ("Lähliittie", INTEGER), ("Suuntlkm", INTEGER), ("Toimenpide", INTEGER),
    ("Toimpidsel", STRING), ("Luovpvm", STRING), ("Valaisomis", INTEGER), ("Valomsel", STRING), ("Poikkileik", INTEGER),
    ("Poikleikse", STRING), ("Päällyslev", INTEGER), ("Päällystlk", INTEGER), ("Päällksel", STRING), ("Nakos150", INTEGER),
    ("Nakos300", INTEGER), ("Nakos460", INTEGER), ("Runkotie", INTEGER), ("Raskos", STRING),
)

# The person table.
PERSON_FIELDS = (
    ("Onnett_id", INTEGER), ("Osall_id", INTEGER), ("Henkilo_id", INTEGER), ("Osnro", INTEGER), ("Kulj_matk", STRING),
    ("Ikä", INTEGER), ("Sukupuoli", STRING), ("Kortti", STRING), ("Seuraus", STRING), ("Seuraussel", STRING),
    ("Kulj_kans", STRING), ("Ajokortlk", STRING), ("Ajokortikä", INTEGER),
)

# The party (vehicle / road user) table.
PARTY_FIELDS = (
    ("Onnett_id", INTEGER), ("Osall_id", INTEGER), ("Osnro", INTEGER), ("Oslaji", INTEGER), ("Oslajisel", STRING),
    ("Peräv", INTEGER), ("Perävsel", STRING), ("Ajolaji", INTEGER), ("Ajolajisel", STRING), ("Kuollut", INTEGER),
    ("Loukk", INTEGER), ("Ajoneuvika", INTEGER), ("Ajoneuvmas", INTEGER),
)

DELIMITER = ";"


def struct_of(fields, overrides: dict[str, T.DataType] | None = None) -> T.StructType:
    """StructType for a field list; ``overrides`` maps names to other types."""
    return T.StructType([T.StructField(n, (overrides or {}).get(n, t), True) for n, t in fields])


# Coordinates are read as doubles so fractional grid values never fail a cast.
ACCIDENT_SCHEMA = struct_of(ACCIDENT_FIELDS, {"X": DOUBLE, "Y": DOUBLE})
PERSON_SCHEMA = struct_of(PERSON_FIELDS)
PARTY_SCHEMA = struct_of(PARTY_FIELDS)


def position_of(name: str) -> int:
    """0-based position of an accident-table column in a raw line."""
    for i, (n, _) in enumerate(ACCIDENT_FIELDS):
        if n == name:
            return i
    raise KeyError(name)
