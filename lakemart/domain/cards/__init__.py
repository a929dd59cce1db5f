"""The card market: five feeds, five keyed tables, one dimension and one fact."""
