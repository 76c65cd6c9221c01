"""DataFrame operators: ranking, calendars, upserts, dimension sync, quality, profiles."""
