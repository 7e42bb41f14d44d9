"""The reports are only comparable if these stay as they are."""

# No category or product was clicked.
NO_CLICK = -1

# Percent patterns: city shares print "0.55%", conversion rates print ".55%".
SHARE_PATTERN = "0.00%"
RATE_PATTERN = ".00%"

# Label of the share that the leading cities leave over.
OTHER_LABEL = "其他"

# Clicks of one user on one ad on one day that put the user on the blacklist.
BLACKLIST_THRESHOLD = 10000

# Ad-click messages.
CLICK_TOPIC = "ads_log"
CLICK_GROUP = "commerce-consumer-group"
BATCH_INTERVAL = "5 seconds"
