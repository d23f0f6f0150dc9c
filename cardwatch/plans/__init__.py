"""The registered queries and the SQL that states each result independently."""
