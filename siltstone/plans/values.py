"""Fixed values of the listening log and its tables."""

# Log pages, sign-in state and subscription levels as they occur in the data.
PLAY_PAGE = "NextSong"
UPGRADE_PAGE = "Submit Upgrade"
DOWNGRADE_PAGE = "Submit Downgrade"
SIGNED_IN = "Logged In"
PAID = "paid"
FREE = "free"

# How a level row came about.
TRANSITION = "transition"
INITIAL = "initial"

# Seconds by which a play's length may differ from its version's duration, and the
# share of unresolved versions at which a load is rejected.
DURATION_TOLERANCE = 0.01
UNRESOLVED_LIMIT = 0.30

LEVEL_AFTER = {UPGRADE_PAGE: PAID, DOWNGRADE_PAGE: FREE}
