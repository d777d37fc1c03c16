"""Lookup tables, constants and patterns that results depend on.

They are data, stated as text in their natural order, and every plan takes them
as defaults that a caller may replace.
"""

from __future__ import annotations

# Section type codes and names (two names end in space + tab).
TOPIC_TYPES = [
    ("BI", "Bill Introduced \t"),
    ("BP", "Second or Third Reading Bills"),
    ("OA", "Oral Answers to Questions"),
    ("OS", "Oral Statement"),
    ("WA", "Written Answers to Questions \t"),
    ("WS", "Correction by Written Statements"),
    ("WANA", "Written Answer to Question for Oral Answer not Answered by End of Question Time"),
]

# Ministries in the order in which they are looked for.
MINISTRIES = [
    "Communications and Information",
    "Information Communications and the Arts",
    "Culture Community and Youth",
    "Community Development Youth and Sports",
    "Defence",
    "Education",
    "Finance",
    "Foreign Affairs",
    "Health",
    "Home Affairs",
    "Law",
    "Manpower",
    "National Development",
    "Social and Family Development",
    "Sustainability and the Environment",
    "Environment and Water Resources",
    "Trade and Industry",
    "Transport",
    "Prime Minister",
]

# Bill titles corrected when the title is exactly the key.
BILL_TITLE_EXACT = {
    "Central Provident Fund (Amendment No.2) Bill": "Central Provident Fund (Amendment No 2) Bill",
    "Co-operatives Societies (Amendment) Bill": "Co-operative Societies (Amendment) Bill",
    "Criminal Law (Temporary Provisions) Amendment Bill": "Criminal Law (Temporary Provisions) (Amendment) Bill",
    "Final Supply (FY2015) Bill": "Final Supply (FY 2015) Bill",
    "Economic Expansion Incentives (Relief From Income Tax) (Amendment) Bill": "Economic Expansion Incentives (Relief from Income Tax) (Amendment) Bill",
    "Good and Services Tax (Amendment) Bill": "Goods and Services Tax (Amendment) Bill",
    "Housing and Development Board (Amendment) Bill": "Housing and Development (Amendment) Bill",
    "Income Tax (Amendment) (No 3) Bill": "Income Tax (Amendment No 3) Bill",
    "Motor Vehicles (Third-party Risks and Compensation) (Amendment) Bill": "Motor Vehicles (Third-Party Risks and Compensation) (Amendment) Bill",
    "Second Supplementary Supply (2021) Bill": "Second Supplementary Supply (FY 2021) Bill",
    "Statue Law Reform Bill": "Statute Law Reform Bill",
    "Supplementary Supply (FY2016) Bill": "Supplementary Supply (FY 2016) Bill",
    "Supplementary Supply (FY2017) Bill": "Supplementary Supply (FY 2017) Bill",
    "Supplementary Supply (FY2019) Bill": "Supplementary Supply (FY 2019) Bill",
    "Supplementary Supply (FY2022) Bill": "Supplementary Supply (FY 2022) Bill",
    "Tobacco (Control of Advertisements and Sale (Amendment) Bill": "Tobacco (Control of Advertisements and Sale) (Amendment) Bill",
}
# Corrected when the trimmed title is the key.
BILL_TITLE_TRIMMED = {
    "Financial Services and Markets (Amendments) Bill": "Financial Services and Markets (Amendment) Bill",
    "Supply BIll": "Supply Bill",
}
# Corrected when the title starts with the key.
BILL_TITLE_PREFIX = {
    "Supplementary Supply (FY2023) Bill": "Supplementary Supply (FY 2023) Bill",
}

# Corrections to the list of introduced bills.
INTRODUCED_TITLE_EXACT = {
    "Foreign Interference (countermeasures) Bill": "Foreign Interference (Countermeasures) Bill",
    "Monetary Authority of  Singapore (Amendment) Bill": "Monetary Authority of Singapore (Amendment) Bill",
}
INTRODUCED_TITLE_BY_NUMBER = {
    "22/2023": "Constitution of the Republic of Singapore (Amendment No. 2) Bill",
}

# Patterns and words looked for in speech texts.
PRIMARY_QUESTION_TYPES = ["OA", "WA", "WANA"]
ASK_WORDS = ["asked", "to ask", "as ked"]
ADDRESSEE_WORDS = ["minister", "parliamentary secretary"]
STOOD_IN_NAME = "following question stood in the name"
MINISTER_PUNCTUATION = r"[,();]+"
MINISTER_PATTERN = r"Minister for (\S+(?: \S+){0,6})"
SECOND_READING_WORDS = ["second reading", "second time"]
THIRD_READING_WORDS = ["third reading", "third time"]
VERNACULAR_MARK = "vernacular speech"
VERNACULAR_LANGUAGE_PATTERN = r"\(in (mandarin|malay|tamil)\)"
NON_MEMBER_WORDS = ["deputy", "speaker", "chairman"]

# Section types of bill, procedural and written records.
BILL_TYPES = ["BI", "BP"]
PROCEDURAL_TYPES = ["BI", "WS"]
WRITTEN_TYPES = ["WA", "WANA"]
BILL_INTRODUCED, BILL_DEBATED = "BI", "BP"
READINGS = ["1 First", "2 Second", "3 Third"]
NOMINATED_PARTY, NOMINATED_SEAT = "NMP", "Nominated Member of Parliament"

# Fixed values: (member, first date, last date) recorded absent though never seated.
ATTENDANCE_EXCLUSIONS = [("lee li lian", "2016-01-15", "2020-06-23")]

# Dates.
FULL_NAME_SCRAPED_ON = "2024-05-16"
STALE_CLOSE_DATE = "2025-04-14"
FIRST_SESSION = (12, 1)
FIRST_SESSION_START = "2010-10-10"

# Flesch reading-ease coefficients.
FLESCH = (206.835, 1.015, 84.6)
