"""The registered queries. Importing a module of this package registers what it defines."""
