"""Declared columns of the spreadsheet exports and the projections made of them."""

from __future__ import annotations

# Sheet name -> columns and declared types.
SHEETS = {
    "member_of_parliament": {
        "member_name": "string", "constituency": "string", "from_date": "string", "to_date": "string",
        "accessed_at": "string",
    },
    "ethnicity": {"member_name": "string", "ethnicity": "string", "is_ethnicity_certain": "string"},
    "year_of_birth": {"member_name": "string", "year_of_birth": "string", "accessed_at": "string"},
    "office_holding": {
        "member_name": "string", "position": "string", "from_date": "string", "to_date": "string",
        "accessed_at": "string",
    },
    "member_name_mapping": {"member_name": "string", "possible_variation": "string"},
    "member_image_link": {"member_name": "string", "member_image_link": "string", "accessed_at": "string"},
    "party": {"member_name": "string", "party": "string", "parliament": "bigint"},
    "member_name_link": {"member_name": "string", "member_link_name": "string", "accessed_at": "string"},
    "gender": {"member_name": "string", "gender": "string"},
}

# Staged sheet -> (sheet, {column: (source column, type)}).
STAGED_SHEETS = {
    "stg_gsheet_member_ethnicity": (
        "ethnicity", {"member_name": ("member_name", "string"), "member_ethnicity": ("ethnicity", "string")},
    ),
    "stg_gsheet_member_gender": (
        "gender", {"member_name": ("member_name", "string"), "gender": ("gender", "string")},
    ),
    "stg_gsheet_member_image_link": (
        "member_image_link",
        {
            "member_name": ("member_name", "string"),
            "member_image_link": ("member_image_link", "string"),
            "accessed_at": ("accessed_at", "date"),
        },
    ),
    "stg_gsheet_member_name_link": (
        "member_name_link",
        {
            "member_name": ("member_name", "string"),
            "member_name_website": ("member_link_name", "string"),
            "accessed_at": ("accessed_at", "date"),
        },
    ),
    "stg_gsheet_member_of_parliament": (
        "member_of_parliament",
        {
            "member_name": ("member_name", "string"),
            "member_constituency": ("constituency", "string"),
            "effective_from_date": ("from_date", "date"),
            "effective_to_date": ("to_date", "date"),
            "accessed_at": ("accessed_at", "date"),
        },
    ),
    "stg_gsheet_member_party": (
        "party",
        {
            "member_name": ("member_name", "string"),
            "party": ("party", "string"),
            "parliament": ("parliament", "bigint"),
        },
    ),
    "stg_gsheet_office_holding": (
        "office_holding",
        {
            "member_name": ("member_name", "string"),
            "member_appointment": ("position", "string"),
            "effective_from_date": ("from_date", "date"),
            "effective_to_date": ("to_date", "date"),
            "accessed_at": ("accessed_at", "date"),
        },
    ),
    "stg_gsheet_year_of_birth": (
        "year_of_birth",
        {
            "member_name": ("member_name", "string"),
            "member_birth_year": ("year_of_birth", "bigint"),
            "accessed_at": ("accessed_at", "date"),
        },
    ),
}
