"""Plans over the star: BI reports, named questions, ad-hoc SELECT, build."""
