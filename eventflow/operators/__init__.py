"""``DataFrame -> DataFrame`` operators.  None of them runs an action, but
for ``live.event_types``, which finds names for columns."""
