"""Physical-plan helpers: size-checked broadcast, materialization to the
shared checkpoint folder, salting for hot keys."""
