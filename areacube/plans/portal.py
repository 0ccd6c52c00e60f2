"""Names the statistics portal expects in every cube."""

# Area level names of the portal's cubes.
LEVEL_DISTRICT = "wijk23"
LEVEL_MUNICIPALITY = "gemeente"
LEVEL_SUBREGION = "subregio"
LEVEL_REGION = "ggd"
LEVEL_COUNTRY = "nederland"

# Prefix of a relabelled copy written next to its input.
RELABELLED_PREFIX = "portal-"
