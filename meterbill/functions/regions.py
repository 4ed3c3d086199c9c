"""City spelling -> administrative region.

The lookup is a literal map evaluated inside the projection, so it needs no
join and no shuffle; its size is fixed (82 spellings).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: city spellings and their regions (as published) -------
REGION_MAPPING = {
    'CASABLANCA': 'Casablanca-Settat',
    'Casablanca': 'Casablanca-Settat',
    'SETTAT': 'Casablanca-Settat',
    'Settat': 'Casablanca-Settat',
    'MOHAMMEDIA': 'Casablanca-Settat',
    'Mohammedia': 'Casablanca-Settat',
    'EL JADIDA': 'Casablanca-Settat',
    'El Jadida': 'Casablanca-Settat',
    'BERRECHID': 'Casablanca-Settat',
    'Berrechid': 'Casablanca-Settat',
    'RABAT': 'Rabat-Salé-Kénitra',
    'Rabat': 'Rabat-Salé-Kénitra',
    'SALE': 'Rabat-Salé-Kénitra',
    'Salé': 'Rabat-Salé-Kénitra',
    'KENITRA': 'Rabat-Salé-Kénitra',
    'Kénitra': 'Rabat-Salé-Kénitra',
    'TEMARA': 'Rabat-Salé-Kénitra',
    'Témara': 'Rabat-Salé-Kénitra',
    'SKHIRAT': 'Rabat-Salé-Kénitra',
    'Skhirat': 'Rabat-Salé-Kénitra',
    'MARRAKECH': 'Marrakech-Safi',
    'Marrakech': 'Marrakech-Safi',
    'SAFI': 'Marrakech-Safi',
    'Safi': 'Marrakech-Safi',
    'ESSAOUIRA': 'Marrakech-Safi',
    'Essaouira': 'Marrakech-Safi',
    'EL KELAA DES SRAGHNA': 'Marrakech-Safi',
    'El Kelaa des Sraghna': 'Marrakech-Safi',
    'FES': 'Fès-Meknès',
    'Fès': 'Fès-Meknès',
    'MEKNES': 'Fès-Meknès',
    'Meknès': 'Fès-Meknès',
    'TAZA': 'Fès-Meknès',
    'Taza': 'Fès-Meknès',
    'SEFROU': 'Fès-Meknès',
    'Sefrou': 'Fès-Meknès',
    'TANGER': 'Tanger-Tétouan-Al Hoceïma',
    'Tanger': 'Tanger-Tétouan-Al Hoceïma',
    'TETOUAN': 'Tanger-Tétouan-Al Hoceïma',
    'Tétouan': 'Tanger-Tétouan-Al Hoceïma',
    'AL HOCEIMA': 'Tanger-Tétouan-Al Hoceïma',
    'Al Hoceïma': 'Tanger-Tétouan-Al Hoceïma',
    'CHEFCHAOUEN': 'Tanger-Tétouan-Al Hoceïma',
    'Chefchaouen': 'Tanger-Tétouan-Al Hoceïma',
    'OUJDA': 'Oriental',
    'Oujda': 'Oriental',
    'NADOR': 'Oriental',
    'Nador': 'Oriental',
    'BERKANE': 'Oriental',
    'Berkane': 'Oriental',
    'TAOURIRT': 'Oriental',
    'Taourirt': 'Oriental',
    'AGADIR': 'Souss-Massa',
    'Agadir': 'Souss-Massa',
    'TIZNIT': 'Souss-Massa',
    'Tiznit': 'Souss-Massa',
    'TAROUDANT': 'Souss-Massa',
    'Taroudant': 'Souss-Massa',
    'INEZGANE': 'Souss-Massa',
    'Inezgane': 'Souss-Massa',
    'BENI MELLAL': 'Béni Mellal-Khénifra',
    'Béni Mellal': 'Béni Mellal-Khénifra',
    'KHENIFRA': 'Béni Mellal-Khénifra',
    'Khénifra': 'Béni Mellal-Khénifra',
    'KHOURIBGA': 'Béni Mellal-Khénifra',
    'Khouribga': 'Béni Mellal-Khénifra',
    'OUARZAZATE': 'Drâa-Tafilalet',
    'Ouarzazate': 'Drâa-Tafilalet',
    'ERRACHIDIA': 'Drâa-Tafilalet',
    'Errachidia': 'Drâa-Tafilalet',
    'ZAGORA': 'Drâa-Tafilalet',
    'Zagora': 'Drâa-Tafilalet',
    'LAAYOUNE': 'Laâyoune-Sakia El Hamra',
    'Laâyoune': 'Laâyoune-Sakia El Hamra',
    'BOUJDOUR': 'Laâyoune-Sakia El Hamra',
    'Boujdour': 'Laâyoune-Sakia El Hamra',
    'DAKHLA': 'Dakhla-Oued Ed-Dahab',
    'Dakhla': 'Dakhla-Oued Ed-Dahab',
    'GUELMIM': 'Guelmim-Oued Noun',
    'Guelmim': 'Guelmim-Oued Noun',
    'TAN-TAN': 'Guelmim-Oued Noun',
    'Tan-Tan': 'Guelmim-Oued Noun',
}
UNDEFINED_REGION = 'Non définie'
OTHER_REGION = 'Autres'

# Probe key: the upper-cased spelling. Looking up upper(strip(city)) here
# gives the same region as trying the raw, title-cased and upper-cased
# spellings in turn, for every spelling and case variant of the keys.
REGION_BY_KEY = {k.upper(): v for k, v in REGION_MAPPING.items()}

_STRIP = r"^\s+|\s+$"


def city_key(city: Column) -> Column:
    return F.upper(F.regexp_replace(city, _STRIP, ""))


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


# one map literal, built as a single SQL expression (one JVM call instead of
# one per entry)
_LOOKUP_SQL = "map(" + ", ".join(f"{_sql_str(k)}, {_sql_str(v)}" for k, v in sorted(REGION_BY_KEY.items())) + ")"


def region_of(city: Column) -> Column:
    lookup = F.expr(_LOOKUP_SQL)
    return (F.when(city.isNull(), F.lit(UNDEFINED_REGION))
            .otherwise(F.coalesce(F.try_element_at(lookup, city_key(city)), F.lit(OTHER_REGION))))


def region_sql(city_sql: str) -> str:
    """The same lookup as an ANSI SQL expression (used by the oracle)."""
    arms = " ".join(
        "WHEN '{}' THEN '{}'".format(k.replace("'", "''"), v.replace("'", "''"))
        for k, v in sorted(REGION_BY_KEY.items()))
    key = f"upper(regexp_replace({city_sql}, '{_STRIP}', '', 'g'))"
    return (f"(CASE WHEN {city_sql} IS NULL THEN '{UNDEFINED_REGION}' "
            f"ELSE COALESCE(CASE {key} {arms} END, '{OTHER_REGION}') END)")
