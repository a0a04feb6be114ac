"""DataFrame -> DataFrame transformations. Nothing here runs an action."""
