"""Arguments shared by the registered queries and their SQL counterparts."""

from datetime import date, timedelta

AS_OF = date(2024, 1, 16)
DAY = date(2024, 1, 15)

EVENTS_CUTOFF = "2024-01-20 12:00:00"
# Up to where a first increment goes, and how far a later one looks back from there.
SECOND_LOAD = "2024-01-25 18:30:00"
LOOK_BACK = timedelta(days=7)

# What counts as valid among the events: any customer but number 0, and sales by click or
# purchase (see the ids in the adapters).
FIRST_CUSTOMER, LAST_CUSTOMER = 1, 2**62
VALID_METHODS = (1, 3)

# Trucks are named like nations.
TRUCK = "NATION_12"
SELECTED = ("NATION_2", "NATION_7", "NATION_12", "NATION_18", "NATION_21")
