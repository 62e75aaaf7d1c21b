"""Recoding by ordered rules: the first rule that matches gives the label, and labels keep the order of their rules."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, int, str]


def recode(rules: list[Rule]) -> Column:
    """struct(label, ord) of the first rule (column, code, label) that holds; null if none does.

    ``ord`` is the place of the label's first rule. Rules that follow each other on one column are one constant map, so a row
    takes a lookup for each such run and no join, whatever the number of rules.
    """
    place: dict[str, int] = {}
    for _, _, label in rules:
        place.setdefault(label, len(place) + 1)
    found = []
    for column, run in groupby(rules, key=lambda rule: rule[0]):
        codes: dict[int, str] = {}
        for _, code, label in run:
            codes.setdefault(code, label)
        items = (x for code, label in codes.items() for x in (F.lit(code), F.struct(F.lit(label).alias("label"), F.lit(place[label]).alias("ord"))))
        found.append(F.try_element_at(F.create_map(*items), F.col(column).cast("int")))
    return F.coalesce(*found)


# The survey's code columns with the label of each code, in the order in which columns and codes are tried.
TRADITION_CODES: dict[str, dict[int, str]] = {
    "baptist": {
        1: "Southern Baptist", 2: "ABCUSA", 3: "Natl. Baptist Convention", 4: "Progressive Baptist Convention", 5: "Independent Baptist",
        6: "Baptist General Conference", 7: "Baptist Miss. Association", 8: "Conservative Bapt. Association", 9: "Free Will Baptist",
        10: "Gen. Assoc. of Reg. Bapt.", 90: "Other Baptist",
    },
    "methodist": {1: "United Methodist", 2: "Free Methodist", 3: "African Methodist Episcopal", 4: "AME - Zion", 5: "Christian Methodist Episcopal", 90: "Other Methodist"},
    "nondenom": {1: "Nondenom Evangelical", 2: "Nondenom Fundamentalist", 3: "Nondenom Charismatic", 4: "Interdenominational", 5: "Community Church", 90: "Other Nondenom"},
    "lutheran": {1: "ELCA", 2: "Lutheran - Missouri Synod", 3: "Lutheran - Wisconsin Synod", 4: "Other Lutheran"},
    "presbyterian": {
        1: "PCUSA", 2: "PCA", 3: "Associated Reformed Presbyterian", 4: "Cumberland Presbyterian", 5: "Orthodox Presbyterian",
        6: "Evangelical Presbyterian", 90: "Other Presbyterian",
    },
    "pentecostal": {
        1: "Assemblies of God", 2: "Church of God Cleveland TN", 3: "Four Square Gospel", 4: "Pentecostal Church of God", 5: "Pentecostal Holiness Church",
        6: "Church of God in Christ", 7: "Church of God of the Apostolic Faith", 8: "Assembly of Christian Churches", 9: "Apostolic Christian", 90: "Other Pentecostal",
    },
    "episcopal": {1: "TEC", 2: "Church of England", 3: "Anglican Orthodox", 4: "Reformed Episcopal", 90: "Other Episcopal"},
    "christian": {1: "Church of Christ", 2: "Disciples of Christ", 3: "Christian Church", 90: "Other Christian Church"},
    "congregational": {1: "United Church of Christ", 2: "Conservative Cong. Christian", 3: "National Assoc. of Cons. Cong.", 90: "Other Cong."},
    "holiness": {1: "Church of the Nazarene", 2: "Wesleyan Church", 4: "Christian and Missionary Alliance", 5: "Church of God", 6: "Salvation Army"},
    "reformed": {1: "Reformed Church in America", 2: "Christian Reformed", 90: "Other Reformed"},
    "adventist": {1: "Seventh Day Adventist"},
}


def tradition() -> Column:
    """struct(label, ord) of a respondent's religious tradition."""
    return recode([(column, code, label) for column, codes in TRADITION_CODES.items() for code, label in codes.items()])
