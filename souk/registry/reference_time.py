"""The ``as_of`` moments that go with the given test tables."""

ORDERS = "2001-08-02"
EVENTS = "2024-01-31"
SEGMENTS = "2001-08-01"
REFRESHES = ("2024-01-29 10:30:00", "2024-01-30 10:20:00")
