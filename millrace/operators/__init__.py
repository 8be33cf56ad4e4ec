"""DataFrame operators: cleansing, time scopes, roll-ups, reports, merging, dashboard sections."""
