"""Physical choices made from measured sizes, and the catalogue of registered queries."""
