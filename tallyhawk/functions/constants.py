"""Fixed values of the warehouse model.

Fixed values (must stay as they are for results to match the report format):
  technical infinity date           9999-12-31
  technical infinity timestamp      9999-12-31 00:00:00
  deletion flag values              'N' (live version), 'Y' (delete marker)
  operation results                 'SUCCESS', 'REJECT'
  fraud event types                 1 expired or blacklisted passport
                                    2 expired contract
                                    3 operations in different cities within one hour
                                    4 amount probing
  rule 3 default window             1 hour
  rule 4 default window             20 minutes, 3 rejected operations before the success
  file name date pattern            8 digits, day month year (DDMMYYYY)
  declared text length limits       client_id 10, last_name 20, first_name 20, patronymic 20,
                                    passport_num 15, phone 16, account_num 20, card_num 20
  source -> warehouse column names  clients: client_id last_name first_name patronymic
                                             date_of_birth passport_num passport_valid_to phone
                                    accounts: account -> account_num, valid_to, client
                                    cards: card_num, account -> account_num
"""

from __future__ import annotations

INF_DATE = "9999-12-31"
INF_TS = "9999-12-31 00:00:00"

LIVE = "N"
DELETED = "Y"

SUCCESS = "SUCCESS"
REJECT = "REJECT"

EVENT_PASSPORT = 1
EVENT_CONTRACT = 2
EVENT_CITY_HOP = 3
EVENT_AMOUNT_PROBE = 4

EVENT_TYPES = [
    (EVENT_PASSPORT, "Operation with an expired or blacklisted passport"),
    (EVENT_CONTRACT, "Operation under an expired contract"),
    (EVENT_CITY_HOP, "Operations in different cities within one hour"),
    (EVENT_AMOUNT_PROBE, "Amount probing"),
]

CITY_HOP_WINDOW_SECONDS = 3600
AMOUNT_PROBE_WINDOW_SECONDS = 20 * 60
AMOUNT_PROBE_REJECTS = 3

FILE_DATE_REGEX = "([0-9]{8})"
FILE_DATE_FORMAT = "ddMMyyyy"

# Source table -> (source column, warehouse column) in source order.  The
# first pair is the business key; create_dt/update_dt follow the attributes.
SOURCE_COLUMNS = {
    "clients": [
        ("client_id", "client_id"),
        ("last_name", "last_name"),
        ("first_name", "first_name"),
        ("patronymic", "patronymic"),
        ("date_of_birth", "date_of_birth"),
        ("passport_num", "passport_num"),
        ("passport_valid_to", "passport_valid_to"),
        ("phone", "phone"),
    ],
    "accounts": [
        ("account", "account_num"),
        ("valid_to", "valid_to"),
        ("client", "client"),
    ],
    "cards": [
        ("card_num", "card_num"),
        ("account", "account_num"),
    ],
}

STRING_LIMITS = {
    "client_id": 10,
    "last_name": 20,
    "first_name": 20,
    "patronymic": 20,
    "passport_num": 15,
    "phone": 16,
    "account_num": 20,
    "card_num": 20,
}

CREATE_COL = "create_dt"
UPDATE_COL = "update_dt"

# Warehouse history bookkeeping columns.
FROM_COL = "effective_from"
TO_COL = "effective_to"
FLAG_COL = "deleted_flg"
PROCESSED_COL = "processed_dt"
FILE_DATE_COL = "file_date"

REPORT_COLUMNS = ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
